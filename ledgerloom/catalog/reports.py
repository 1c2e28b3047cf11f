"""Posting summaries, daily feed report and regulatory extracts."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import AS_OF, CTE, EVENTS_AS_OF, clients, loans, money, query, repayments, table
from ledgerloom.operators.dedupe import drop_exact_duplicates, latest_per_key, top_n_per_key
from ledgerloom.plans import reports

CTE.update({
    "core_txn": "select event_id as receipt_number, ts as created_at, cast(value as decimal(18,2)) as amount, case when event_id % 2 = 0 then 'disbursement' else 'repayment' end as kind, k from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)",
    "feed_txn": "select receipt_number, case when k % 3 = 0 then '400' else '200' end as status_code, kind, amount + 1 as amount from core_txn where k < 70",
    "dump_txn": "select receipt_number, case when k % 4 = 0 then '400' else '200' end as status_code, kind, amount + 2 as amount from core_txn where k >= 30 and k < 90",
    "traced": """select c.*, cast(c.created_at as date) as day, f.status_code as fs, f.kind as fk, f.amount as fa, d.status_code as ds, d.kind as dk, d.amount as da, f.receipt_number is null as no_feed,
        f.receipt_number is null and d.receipt_number is null as no_dump from core_txn c left join feed_txn f using (receipt_number) left join dump_txn d using (receipt_number)""",
})
_TRACED = ("core_txn", "feed_txn", "dump_txn", "traced")


def _traced(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    core = table(spark, d, "events").select(F.col("event_id").alias("receipt_number"), F.col("ts").alias("created_at"), money("value").alias("amount"),
                                            F.when(F.col("event_id") % 2 == 0, "disbursement").otherwise("repayment").alias("kind"), k.alias("k"))
    feed = core.filter("k < 70").select("receipt_number", F.when(F.col("k") % 3 == 0, "400").otherwise("200").alias("status_code"), "kind", (F.col("amount") + 1).alias("amount"))
    dump = core.filter("k >= 30 and k < 90").select("receipt_number", F.when(F.col("k") % 4 == 0, "400").otherwise("200").alias("status_code"), "kind", (F.col("amount") + 2).alias("amount"))
    return core, feed, dump


def _posting_sql():
    conditions = {
        "feed_ok": ("fk = '{k}' and fs = '200'", "fa"), "feed_failed": ("fk = '{k}' and fs = '400'", "fa"), "dump_ok_missing_in_feed": ("no_feed and ds = '200' and dk = '{k}'", "da"),
        "dump_ok_failed_in_feed": ("fk = '{k}' and fs = '400' and ds = '200' and dk = '{k}'", "da"), "manual_failed_in_both": ("fk = '{k}' and fs = '400' and ds = '400' and kind = '{k}'", "amount"),
        "manual_missing_in_both": ("no_feed and no_dump and kind = '{k}'", "amount")}
    out = []
    for kind in ("disbursement", "repayment"):
        for name, (cond, amount) in conditions.items():
            cond = cond.format(k=kind)
            out += [f"count({amount}) filter (where {cond}) as {kind}_volume_{name}", f"cast(coalesce(sum({amount}) filter (where {cond}), 0) as double) as {kind}_value_{name}"]
    columns = ", ".join(out)
    return f"""with days as (select cast(unnest(generate_series(date '2024-01-01', date '2024-01-31', interval 1 day)) as date) as day)
        select days.day, {columns} from days left join traced on traced.day = days.day group by days.day"""


@query("posting_summary", _posting_sql(), _TRACED)
def posting_summary(spark, d):
    return reports.posting_summary(spark, *_traced(spark, d), EVENTS_AS_OF)


@query("provenance", "select receipt_number, fs as feed_status, ds as dump_status, no_feed as missing_in_feed, no_dump as missing_in_dump from traced", _TRACED)
def provenance(spark, d):
    return reports.provenance(*_traced(spark, d)).select("receipt_number", "feed_status", "dump_status", "missing_in_feed", "missing_in_dump")


@query("opt_in_summary", """
with days as (select cast(unnest(generate_series(date '2001-07-02', date '2001-08-01', interval 1 day)) as date) as day),
f as (select distinct loan_id, case when flag = 'R' then '400' else '200' end as fs from repayments where line = 1), g as (select distinct loan_id, case when flag = 'A' then '400' else '200' end as ds from repayments where line = 2),
r as (select l.disbursed_on as d, f.loan_id as fl, fs, g.loan_id as gl, ds from loans l left join f using (loan_id) left join g using (loan_id))
select day, count(*) filter (where fs = '200') as feed_ok, count(*) filter (where fs = '400') as feed_failed, count(*) filter (where d is not null and fl is null and ds = '200') as dump_ok_missing_in_feed,
  count(*) filter (where fs = '400' and ds = '200') as dump_ok_failed_in_feed, count(*) filter (where fs = '400' and ds = '400') as manual_failed_in_both,
  count(*) filter (where d is not null and fl is null and gl is null) as manual_missing_in_both from days left join r on r.d = days.day group by day""", ("loans", "repayments"))
def opt_in_summary(spark, d):
    r = repayments(spark, d)
    seen = lambda line, bad: r.filter(F.col("line") == line).select(F.col("loan_id").alias("store_number"), F.when(F.col("flag") == bad, "400").otherwise("200").alias("status_code"), F.lit(True).alias("is_opt_in")).distinct()
    people = loans(spark, d).select(F.col("loan_id").alias("store_number"), F.col("disbursed_on").alias("submitted_on"))
    return reports.opt_in_summary(spark, people, seen(1, "R"), seen(2, "A"), AS_OF)


@query("feed_day_report", """
with e as (select *, cast(value as decimal(18,2)) as amount from events where cast(ts as date) = date '2024-01-15')
select coalesce(max(ts) filter (where event_type in ('purchase', 'click')), timestamp '2024-01-15') as as_at, count(*) filter (where event_type = 'signup') as opt_ins, count(*) filter (where event_type = 'purchase') as disbursements,
  count(*) filter (where event_type = 'click') as repayments, cast(coalesce(sum(amount) filter (where event_type = 'purchase'), 0) as double) as disbursed, cast(coalesce(sum(amount) filter (where event_type = 'click'), 0) as double) as repaid from e""")
def feed_day_report(spark, d):
    rows = table(spark, d, "events").select("ts", money("value").alias("amount"), "event_type")
    one = lambda kind: rows.filter(F.col("event_type") == kind)
    return reports.feed_day(one("signup"), one("purchase"), one("click"), dt.date(2024, 1, 15))


@query("loan_book", """
select l.loan_id, l.client_id, client_name, l.loan_status, n_name as office, disbursed_on, matures_on, cast(principal as double) as principal, coalesce(cast(paid as double), 0) as repaid
from loans l join clients c using (client_id) join nation on n_nationkey = office_id left join (select loan_id, sum(amount) as paid from repayments group by 1) using (loan_id) where disbursed_on > date '1998-05-31'""", ("loans", "clients", "repayments"))
def loan_book(spark, d):
    paid = repayments(spark, d).groupBy("loan_id").agg(F.sum("amount").cast("double").alias("repaid"))
    offices = table(spark, d, "nation").select(F.col("n_nationkey").alias("office_id"), F.col("n_name").alias("office"))
    book = loans(spark, d).filter(F.col("disbursed_on") > F.lit(dt.date(1998, 5, 31)))
    return book.join(clients(spark, d), "client_id").join(offices, "office_id").join(paid, "loan_id", "left").select(
        "loan_id", "client_id", "client_name", "loan_status", "office", "disbursed_on", "matures_on", F.col("principal").cast("double").alias("principal"),
        F.coalesce("repaid", F.lit(0.0)).alias("repaid"))


@query("repayment_list", """
select loan_id, line, staff_id, paid_on, 'ContractID_' || loan_id as contract_id, cast(amount as double) as amount, 'dump' as source from repayments""", ("repayments",))
def repayment_list(spark, d):
    return repayments(spark, d).select("loan_id", "line", "staff_id", "paid_on", F.concat(F.lit("ContractID_"), F.col("loan_id").cast("string")).alias("contract_id"),
                                       F.col("amount").cast("double").alias("amount"), F.lit("dump").alias("source"))


@query("dump_export_latest", """
select loan_id, line, staff_id, paid_on from (select *, rank() over (partition by loan_id, line order by paid_on) as r from (select distinct loan_id, line, staff_id, paid_on, flag from repayments)) where r = 1 and paid_on >= date '2000-01-01'""", ("repayments",))
def dump_export_latest(spark, d):
    """Copies removed over the whole dump, then the first record per key."""
    rows = repayments(spark, d).select("loan_id", "line", "staff_id", "paid_on", "flag")
    one = drop_exact_duplicates(rows, ["loan_id", "line", "staff_id", "flag", "paid_on"], ["paid_on"], ties="one")
    return latest_per_key(one, ["loan_id", "line"], F.col("paid_on").asc()).filter(F.col("paid_on") >= F.lit(dt.date(2000, 1, 1))).drop("flag")


@query("dump_export_top3", """
select loan_id, staff_id, line, paid_on from (select *, rank() over (partition by loan_id order by staff_id) as r from repayments where line_status = 'O') where r <= 3 and paid_on = date '2000-06-15'""", ("repayments",))
def dump_export_top3(spark, d):
    rows = repayments(spark, d).filter("line_status = 'O'")
    return top_n_per_key(rows, "loan_id", F.col("staff_id"), 3).filter(F.col("paid_on") == F.lit(dt.date(2000, 6, 15))).select("loan_id", "staff_id", "line", "paid_on")


CTE["reg_loans"] = """select *, principal / 2 as total_outstanding, loan_id % 40 as fees, loan_id % 7 as penalty, loan_id % 25 as product_id from loans"""


def _reg_loans(spark, d):
    half = F.col("principal").cast("double") / 2
    return loans(spark, d).withColumns({
        "total_outstanding": half, "principal_outstanding": half, "principal_repaid": half, "fees": F.col("loan_id") % 40, "penalty": F.col("loan_id") % 7, "product_id": F.col("loan_id") % 25})


def _reg_clients(spark, d):
    return clients(spark, d).select("client_id", (F.col("client_id") % 101).alias("similarity"), F.upper("client_name").alias("registry_name"), "client_name")


@query("regulatory_accounts", """
select row_number() over (order by loan_id) as row_id, 'LN-417' as lender_code, '01-Aug-2001' as reporting_date, 'T2_' || client_id as customer_id, 'T2_' || loan_id as contract_number,
  case when client_id % 101 >= 60 then upper(client_name) else client_name end as account_name, strftime(disbursed_on, '%d-%b-%Y') as disbursement_date, cast(principal as double) as principal,
  cast(principal as double) / 2 as outstanding, cast(fees + penalty as double) as other_charge, 'C2' as channel, product_id * 2 as tenor, 'S' || loan_status as account_status
from reg_loans join clients using (client_id)""", ("loans", "clients", "reg_loans"))
def regulatory_accounts(spark, d):
    products = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("product_id"), (F.col("n_nationkey") * 2).cast("long").alias("repay_every"))
    statuses = loans(spark, d).select("loan_status").distinct().withColumn("status_code", F.concat(F.lit("S"), F.col("loan_status").cast("string")))
    channels = table(spark, d, "region").select(F.when(F.col("r_regionkey") == 2, "USSD").otherwise(F.col("r_name")).alias("channel_type"), F.concat(F.lit("C"), F.col("r_regionkey").cast("string")).alias("code"))
    return reports.accounts(_reg_loans(spark, d).drop("channel"), _reg_clients(spark, d), products, statuses, channels, "LN-417", "T2", AS_OF)


@query("regulatory_overdue", """
select row_number() over (order by loan_id) as row_id, 'LN-417' as lender_code, '01-Aug-2001' as reporting_date, 'T2_' || client_id as customer_id, 'T2_' || loan_id as contract_number,
  strftime(matures_on + 90, '%d-%b-%Y') as overdue_date, cast(principal as double) / 2 as principal_arrears, cast(principal as double) / 2 as outstanding
from reg_loans join clients using (client_id) where loan_status = 300 and date '2001-08-01' - (matures_on + 90) >= 1""", ("loans", "clients", "reg_loans"))
def regulatory_overdue(spark, d):
    return reports.overdue_accounts(_reg_loans(spark, d), _reg_clients(spark, d), "LN-417", "T2", AS_OF)


@query("regulatory_repayments", """
with t as (select loan_id, paid_on, case when flag = 'R' then 1 else 0 end as rev, case when line = 7 then 'T_R' when line = 6 then 'waiver' when line <> 5 then 'T' || line end as receipt from repayments),
v as (select loan_id, max(paid_on) as paid_on from t where rev = 0 and (receipt is null or (lower(receipt) not like '%\\_r%' escape '\\' and lower(receipt) not like '%waiv%')) group by 1)
select row_number() over (order by loan_id) as row_id, 'LN-417' as lender_code, '01-Aug-2001' as reporting_date, 'T2_' || client_id as customer_id, 'T2_' || loan_id as contract_number,
  cast(principal as double) / 2 as outstanding, strftime(paid_on, '%d-%b-%Y') as repayment_date, cast(principal as double) / 2 as principal_repaid from reg_loans join clients using (client_id) join v using (loan_id) where loan_status = 300""",
       ("loans", "clients", "repayments", "reg_loans"))
def regulatory_repayments(spark, d):
    line = F.col("line")
    receipt = F.when(line == 7, "T_R").when(line == 6, "waiver").when(line != 5, F.concat(F.lit("T"), line.cast("string")))
    r = repayments(spark, d).select("loan_id", "paid_on", F.when(F.col("flag") == "R", 1).otherwise(0).alias("is_reversed"), receipt.alias("receipt_number"),
                                    F.concat_ws("-", "line", "part_id", "staff_id", "amount").alias("transaction_id"))
    return reports.last_repayments(_reg_loans(spark, d), _reg_clients(spark, d), r, "LN-417", "T2", AS_OF)


@query("regulatory_customers", """
with k as (select *, client_id % 101 as sim, case client_id % 3 when 0 then 'Male' when 1 then 'Female' end as gender, date '2001-08-01' - cast(client_id % 9000 as integer) as birth,
    case when client_id % 6 = 0 then 'P' || client_id else cast(client_id as varchar) end as nid from clients where client_id in (select client_id from loans)),
n as (select *, case when sim >= 60 then upper(segment) else segment end as f, case when sim >= 60 then 'REG' else 'own' end as m, case when sim >= 60 then null else client_name end as l from k where gender is not null)
select row_number() over (order by client_id) as row_id, 'LN-417' as lender_code, '01-Aug-2001' as reporting_date, 'T2_' || client_id as customer_id, case when client_id % 6 = 0 then 'D1' else 'D0' end as document_code, nid as national_id,
  case gender when 'Male' then 'G0' else 'G1' end as gender_code, f as first_name, case when l is not null then m end as middle_name, coalesce(l, m) as surname, strftime(birth, '%d-%b-%Y') as birth_date, '01-Aug-2001' as onboarding_date,
  '2547' || client_id as mobile_number from n""", ("loans", "clients"))
def regulatory_customers(spark, d):
    k = F.col("client_id")
    people = clients(spark, d).select(
        "client_id", (k % 101).alias("similarity"), F.when(k % 3 == 0, "Male").when(k % 3 == 1, "Female").alias("gender"), F.date_sub(F.lit(dt.date(2001, 8, 1)), (k % 9000).cast("int")).alias("birth_date"),
        F.when(k % 6 == 0, F.concat(F.lit("P"), k.cast("string"))).otherwise(k.cast("string")).alias("national_id"), F.upper("segment").alias("registry_first"), F.lit("REG").alias("registry_middle"),
        F.lit(None).cast("string").alias("registry_last"), F.col("segment").alias("first_name"), F.lit("own").alias("middle_name"), F.col("client_name").alias("last_name"),
        F.lit(dt.date(2001, 8, 1)).alias("submitted_on"), F.concat(F.lit("2547"), k.cast("string")).alias("mobile_number"))
    code = lambda prefix: F.concat(F.lit(prefix), F.col("r_regionkey").cast("string")).alias("code")
    two = table(spark, d, "region").filter("r_regionkey < 2")
    genders = two.select(F.when(F.col("r_regionkey") == 0, "Male").otherwise("Female").alias("type"), code("G"))
    documents = two.select(F.when(F.col("r_regionkey") == 0, "National Identity Card").otherwise("Passport").alias("type"), code("D"))
    return reports.customers(people, loans(spark, d), genders, documents, "LN-417", "T2", AS_OF)
