"""Ranks, top rows, copies and numbering."""
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import clients, loans, query, repayments, table
from ledgerloom.operators import dedupe
from ledgerloom.operators.slices import Slices


@query("latest_loan", """
select loan_id, client_id, disbursed_on, cast(principal as double) as principal from (
  select *, rank() over (partition by client_id order by disbursed_on desc) as r from loans) where r = 1""", ("loans",))
def latest_loan(spark, d):
    return dedupe.latest_per_key(loans(spark, d), "client_id", F.col("disbursed_on").desc()).select(
        "loan_id", "client_id", "disbursed_on", F.col("principal").cast("double").alias("principal"))


@query("first_loan_one", """
select client_id, min(loan_id) as loan_id, min(disbursed_on) as disbursed_on from loans l
where not exists (select 1 from loans e where e.client_id = l.client_id and e.disbursed_on < l.disbursed_on) group by client_id""", ("loans",))
def first_loan_one(spark, d):
    return dedupe.pick_per_key(loans(spark, d), ["client_id"], ["disbursed_on", "loan_id"], largest=False).select(
        "client_id", "loan_id", "disbursed_on")


@query("exact_dedup", """
select line, flag, line_status, fee_day as paid_on, cast(fee as double) as fee, max(loan_id) as loan_id from (
  select l_linenumber as line, l_returnflag as flag, l_linestatus as line_status, cast(l_shipdate as date) as fee_day, l_quantity as fee, l_orderkey as loan_id from lineitem)
group by all""")
def exact_dedup(spark, d):
    rows = repayments(spark, d).select("line", "flag", "line_status", "paid_on", F.col("fee").cast("double").alias("fee"), "loan_id")
    return dedupe.drop_exact_duplicates(rows, ["line", "flag", "line_status", "paid_on", "fee"], ["loan_id"], ties="one")


@query("copies_keep_ties", """
select loan_id, line, part_id, staff_id, paid_on from (select *, rank() over (partition by loan_id, line order by paid_on desc) as r from repayments) where r = 1""", ("repayments",))
def copies_keep_ties(spark, d):
    rows = repayments(spark, d).select("loan_id", "line", "part_id", "staff_id", "paid_on")
    return dedupe.drop_exact_duplicates(rows, ["loan_id", "line"], ["paid_on"], ties="all")


@query("top3_per_key", """
select loan_id, line, staff_id, paid_on, cast(amount as double) as amount from (
  select *, rank() over (partition by loan_id order by amount desc) as r from repayments) where r <= 3""", ("repayments",))
def top3_per_key(spark, d):
    return dedupe.top_n_per_key(repayments(spark, d), "loan_id", F.col("amount").desc(), 3).select(
        "loan_id", "line", "staff_id", "paid_on", F.col("amount").cast("double").alias("amount"))


@query("number_in_group", """
select loan_id, channel, disbursed_on, row_number() over (partition by channel order by disbursed_on, loan_id) as seq from loans""", ("loans",))
def number_in_group(spark, d):
    """Five groups hold all rows; each is numbered month by month."""
    return dedupe.number_in_group(loans(spark, d), ["channel"], ["disbursed_on", "loan_id"], "seq",
                                  slice_by=F.trunc("disbursed_on", "MM")).select("loan_id", "channel", "disbursed_on", "seq")


@query("number_turns", """
select conv_id, turn, role, row_number() over (partition by conv_id order by turn desc) as from_end from conversations""")
def number_turns(spark, d):
    return dedupe.number_in_group(table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"],
                                  "from_end", descending=True).withColumn("from_end", F.col("from_end").cast("long"))


@query("number_report_rows", "select loan_id, row_number() over (order by loan_id) as row_id from loans", ("loans",))
def number_report_rows(spark, d):
    rows = loans(spark, d).select("loan_id")
    return dedupe.number_in_group(rows, [], ["loan_id"], "row_id", slice_by=Slices(rows, "loan_id"))


@query("dense_rank_status", """
select loan_id, line, staff_id, paid_on, flag from (select *, dense_rank() over (partition by loan_id order by flag) as r from repayments) where r = 1""", ("repayments",))
def dense_rank_status(spark, d):
    return dedupe.best_status_per_key(repayments(spark, d), "loan_id", "flag").select("loan_id", "line", "staff_id", "paid_on", "flag")


@query("status_rank_coalesce", """
select loan_id, line, staff_id, s as status from (select *, rank() over (partition by loan_id order by coalesce(s, '9')) as r from (
  select *, nullif(flag, 'A') as s from repayments)) where r = 1""", ("repayments",))
def status_rank_coalesce(spark, d):
    rows = repayments(spark, d).withColumn("status", F.nullif(F.col("flag"), F.lit("A")))
    return dedupe.latest_per_key(rows, "loan_id", F.coalesce("status", F.lit("9"))).select("loan_id", "line", "staff_id", "status")


@query("avg_rank_latest", """
select client_id, loan_id, rank() over (partition by client_id order by disbursed_on)
  + (count(*) over (partition by client_id, disbursed_on) - 1) / 2 as avg_rank from loans""", ("loans",))
def avg_rank_latest(spark, d):
    return dedupe.average_rank(loans(spark, d), "client_id", "disbursed_on").select("client_id", "loan_id", F.col("avg_rank").cast("double").alias("avg_rank"))


@query("last_two_loans", """
with r as (select client_id, disbursed_on, row_number() over (partition by client_id order by disbursed_on desc, loan_id desc) as n from loans)
select a.client_id, a.disbursed_on as last_on, b.disbursed_on as previous_on, cast(a.disbursed_on - b.disbursed_on as double) as gap_days
from r a left join r b on a.client_id = b.client_id and b.n = 2 where a.n = 1""", ("loans",))
def last_two_loans(spark, d):
    two = dedupe.first_two(loans(spark, d), "client_id", [F.col("disbursed_on").desc(), F.col("loan_id").desc()], ["disbursed_on"])
    return two.select("client_id", F.col("disbursed_on_1").alias("last_on"), F.col("disbursed_on_2").alias("previous_on"),
                      F.datediff("disbursed_on_1", "disbursed_on_2").cast("double").alias("gap_days"))


@query("uniquify_duplicates", """
with base as (select loan_id, cast(client_id as varchar) as nid, disbursed_on as day from loans),
ranked as (select loan_id, day, case when row_number() over (partition by nid, day order by loan_id) > 1
  then nid || '_' || day || '_' || row_number() over (partition by nid, day order by loan_id) else nid end as nid from base)
select loan_id, day, case when nid in (select cast(client_id as varchar) from clients where segment = 'BUILDING') then nid || '_' || day else nid end as nid from ranked""",
       ("loans", "clients"))
def uniquify_duplicates(spark, d):
    rows = loans(spark, d).select("loan_id", F.col("client_id").cast("string").alias("nid"), F.col("disbursed_on").alias("day"))
    taken = clients(spark, d).filter("segment = 'BUILDING'").select(F.col("client_id").cast("string").alias("known"))
    slices = Slices(rows, "loan_id")
    return dedupe.uniquify(rows, "nid", "day", ["loan_id"], taken, "known", slices).select("loan_id", "day", "nid")


@query("ordered_report", "select * from (select loan_id, client_id, disbursed_on from loans order by disbursed_on desc, loan_id limit 100)", ("loans",))
def ordered_report(spark, d):
    """A top-100 report: each task keeps its own best hundred."""
    return loans(spark, d).select("loan_id", "client_id", "disbursed_on").orderBy(F.col("disbursed_on").desc(), "loan_id").limit(100)


@query("recent_versions", "select distinct channel from loans order by channel desc limit 2", ("loans",))
def recent_versions(spark, d):
    return loans(spark, d).select("channel").distinct().orderBy(F.col("channel").desc()).limit(2)
