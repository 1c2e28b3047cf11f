"""Grouped measures, set operations and pivots."""
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import activity, clients, loans, query, repayments, table
from ledgerloom.operators import aggregate, extract, merge


@query("grouped_measures", """
select client_id, count(*) as n_loans, cast(sum(principal) as double) as total, cast(min(principal) as double) as least,
  cast(max(principal) as double) as most, count(distinct channel) as n_channels, min(disbursed_on) as first_on, max(disbursed_on) as last_on,
  cast(sum(principal) as double) / count(*) as mean from loans group by client_id""", ("loans",))
def grouped_measures(spark, d):
    total = F.sum("principal").cast("double")
    return loans(spark, d).groupBy("client_id").agg(
        F.count(F.lit(1)).alias("n_loans"), total.alias("total"), F.min("principal").cast("double").alias("least"),
        F.max("principal").cast("double").alias("most"), F.countDistinct("channel").alias("n_channels"),
        F.min("disbursed_on").alias("first_on"), F.max("disbursed_on").alias("last_on"), (total / F.count(F.lit(1))).alias("mean"))


@query("monthly_then_mean", """
with m as (select staff_id, date_trunc('month', paid_on) as mon, cast(sum(amount) as decimal(28,4)) as s from repayments group by all)
select staff_id, round(cast(sum(s) as double) / count(*), 4) as mean_of_months from m group by staff_id""", ("repayments",))
def monthly_then_mean(spark, d):
    """The mean is taken from exact sums, as the decimal mean would round."""
    sums = aggregate.period_sums(repayments(spark, d), "staff_id", F.trunc("paid_on", "MM"), "amount")
    return sums.groupBy("staff_id").agg(
        F.round(F.sum("_sum").cast("double") / F.count(F.lit(1)), 4).alias("mean_of_months"))


@query("distinct_counts", """
select flag, count(distinct loan_id) as n_loans, count(distinct part_id) as n_parts, count(distinct staff_id) as n_staff from repayments group by flag""", ("repayments",))
def distinct_counts(spark, d):
    return aggregate.distinct_counts(repayments(spark, d), ["flag"], {"n_loans": "loan_id", "n_parts": "part_id", "n_staff": "staff_id"})


@query("monthly_totals", """
select cast(year(paid_on) as bigint) as year, cast(month(paid_on) as bigint) as month, count(*) as total_count, cast(sum(amount) as double) as total_sum
from repayments group by 1, 2""", ("repayments",))
def monthly_totals(spark, d):
    out = aggregate.monthly(repayments(spark, d), "paid_on", total_count=F.count(F.lit(1)), total_sum=F.sum("amount").cast("double"))
    return out.withColumns({"year": F.col("year").cast("long"), "month": F.col("month").cast("long")})


@query("conditional_counts", """
select client_id, count(*) filter (where loan_status = 600) as n_closed, count(*) filter (where loan_status = 300) as n_active,
  cast(coalesce(sum(principal) filter (where loan_status = 300), 0) as double) as active_principal,
  bool_or(loan_status = 700) as any_overpaid, bool_and(loan_status = 600) as all_closed from loans group by client_id""", ("loans",))
def conditional_counts(spark, d):
    s = F.col("loan_status")
    return loans(spark, d).groupBy("client_id").agg(
        F.count_if(s == 600).alias("n_closed"), F.count_if(s == 300).alias("n_active"),
        F.coalesce(F.sum(F.when(s == 300, F.col("principal"))), F.lit(0)).cast("double").alias("active_principal"),
        F.bool_or(s == 700).alias("any_overpaid"), F.bool_and(s == 600).alias("all_closed"))


@query("hourly_rollup", """
select cast(year(ts) as bigint) as year, cast(month(ts) as bigint) as month, cast(day(ts) as bigint) as day, cast(hour(ts) as bigint) as hour,
  count(*) as total_count, cast(sum(credit) as double) as total_sum from activity where ts >= timestamp '2023-10-31' group by 1, 2, 3, 4""", ("activity",))
def hourly_rollup(spark, d):
    recent = activity(spark, d).filter(F.col("ts") >= F.lit("2023-10-31").cast("timestamp_ntz"))
    out = aggregate.hourly(recent, "ts", "credit")
    return out.select(*[F.col(c).cast("long").alias(c) for c in ("year", "month", "day", "hour")], "total_count",
                      F.col("total_sum").cast("double").alias("total_sum"))


def _attempts(spark, d):
    r = F.col("l_returnflag")
    return table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), F.when(F.col("l_linestatus") == "F", "repayment").otherwise("disbursement").alias("kind"),
        F.when(r == "R", 400).otherwise(200).alias("status"),
        F.when(r == "R", F.concat(F.lit("reason "), F.col("l_linenumber").cast("string"))).alias("reason"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("receipt"))


@query("failure_breakdown", """
with a as (select cast(l_shipdate as date) as day, case when l_linestatus = 'F' then 'repayment' else 'disbursement' end as kind,
  case when l_returnflag = 'R' then 400 else 200 end as status, case when l_returnflag = 'R' then 'reason ' || l_linenumber end as reason,
  l_orderkey || '-' || l_linenumber as receipt from lineitem),
t as (select day, count(*) filter (where kind = 'repayment') as successful_repayments, count(*) filter (where kind = 'disbursement') as successful_disbursements
  from a where status = 200 group by day),
f as (select day, kind as failure_kind, reason as failure_reason, count(reason) as failed from a where status = 400
  and receipt not in (select receipt from a where status = 200) group by all)
select t.*, failure_kind, failure_reason, cast(failed as double) as failed from t left join f on t.day = f.day""")
def failure_breakdown(spark, d):
    return aggregate.failure_breakdown(_attempts(spark, d), "day", "kind", "status", "reason", "receipt").withColumn(
        "failed", F.col("failed").cast("double"))


@query("having_conflicts", """
select loan_id, line, count(distinct part_id) as n_values from repayments group by loan_id, line having count(distinct part_id) > 1""", ("repayments",))
def having_conflicts(spark, d):
    return aggregate.conflicting_keys(repayments(spark, d), ["loan_id", "line"], "part_id")


@query("count_by_month_name", """
select strftime(disbursed_on, '%b') as month_name, count(*) as n from loans group by 1""", ("loans",))
def count_by_month_name(spark, d):
    return loans(spark, d).groupBy(F.date_format("disbursed_on", "MMM").alias("month_name")).agg(F.count(F.lit(1)).alias("n"))


@query("rows_at_newest_day", "select loan_id, disbursed_on from loans where disbursed_on = (select max(disbursed_on) from loans)", ("loans",))
def rows_at_newest_day(spark, d):
    from ledgerloom.sources.readers import as_of_latest
    return as_of_latest(loans(spark, d).select("loan_id", "disbursed_on"), "disbursed_on")


@query("shares", """
select flag, cast(count(*) filter (where line_status = 'F') as double) / count(*) as share_final,
  cast(count(*) filter (where fee > 25) as double) / count(*) as share_large from repayments group by flag""", ("repayments",))
def shares(spark, d):
    return repayments(spark, d).groupBy("flag").agg(
        aggregate.share(F.col("line_status") == "F").alias("share_final"), aggregate.share(F.col("fee") > 25).alias("share_large"))


@query("union_all_feeds", """
select loan_id as id, cast(principal as double) as amount, disbursed_on as day, true as is_disbursement, channel from loans
union all select loan_id, cast(amount as double), paid_on, false, null from repayments""", ("loans", "repayments"))
def union_all_feeds(spark, d):
    out = loans(spark, d).select(F.col("loan_id").alias("id"), F.col("principal").cast("double").alias("amount"),
                                 F.col("disbursed_on").alias("day"), F.lit(True).alias("is_disbursement"), "channel")
    back = repayments(spark, d).select(F.col("loan_id").alias("id"), F.col("amount").cast("double").alias("amount"),
                                       F.col("paid_on").alias("day"), F.lit(False).alias("is_disbursement"))
    return out.unionByName(back, allowMissingColumns=True)


@query("union_distinct", """
select paid_on as day, flag from repayments union select disbursed_on, 'L' from loans""", ("loans", "repayments"))
def union_distinct(spark, d):
    return repayments(spark, d).select(F.col("paid_on").alias("day"), "flag").unionByName(
        loans(spark, d).select(F.col("disbursed_on").alias("day"), F.lit("L").alias("flag"))).distinct()


@query("intersect_days", "select paid_on as day from repayments intersect select disbursed_on from loans", ("loans", "repayments"))
def intersect_days(spark, d):
    return repayments(spark, d).select(F.col("paid_on").alias("day")).intersect(loans(spark, d).select(F.col("disbursed_on").alias("day")))


@query("except_ids", "select client_id from clients except select client_id from loans where loan_status = 600", ("clients", "loans"))
def except_ids(spark, d):
    return merge.new_keys(clients(spark, d).select("client_id"), loans(spark, d).filter("loan_status = 600"), "client_id")


@query("eav_pivot", """
select user_id as outlet_id, min_by(props, event_id) filter (where event_type = 'click') as national_id, min_by(props, event_id) filter (where event_type = 'view') as store_number,
  min_by(props, event_id) filter (where event_type = 'signup') as gender from events group by user_id
  having count(*) filter (where event_type in ('click', 'view', 'signup')) > 0""")
def eav_pivot(spark, d):
    return extract.answers_to_columns(table(spark, d, "events").withColumnRenamed("user_id", "outlet_id"), "outlet_id", "event_type", "props",
                                      "event_id", {"click": "national_id", "view": "store_number", "signup": "gender"})
