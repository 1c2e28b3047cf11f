"""Reconciliation and monitoring across sources."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import CTE, clients, loans, money, query, repayments, table
from ledgerloom.operators.joins import missing_from
from ledgerloom.plans import monitoring, recon
from ledgerloom.session import shared_dir
from ledgerloom.sources import sinks

CTE.update({
    "log": """select event_id as log_id, case event_type when 'purchase' then 'loan_request' when 'click' then 'loan_repayment' when 'signup' then 'opt_in' else 'other' end as menu,
        'R' || (event_id % 3000) as receipt, user_id as shop, cast(value as decimal(18,2)) as amount, ts, case when k < 50 then 200 else 400 end as status_code
        from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)""",
    "contracts": """select o_orderkey as surrogate_id, 'K' || o_orderkey as contract_id, 'I' || (o_orderkey % 1000) as identity, strftime(date_trunc('year', o_orderdate), '%Y%m%d') as id_date,
        cast(floor(o_totalprice / 1000) as bigint) as principal, o_custkey % 100 as access_fee, '1000' || (1 + o_orderkey % 4) as product_code, cast(o_orderdate as date) as created_on from orders""",
    "txns": """select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as surrogate_id, l_orderkey as loan_id, 'X' || l_orderkey || '-' || l_linenumber as transaction_id,
        'T' || l_orderkey || '-' || l_linenumber as linked_id, case when l_partkey % 10 <> 0 then 'K' || l_orderkey end as loan_contract_id, 'I' || (l_orderkey % 1000) as owner_id,
        l_linestatus = 'O' as is_disbursement, l_linestatus = 'F' as is_repayment, case when l_returnflag = 'R' then 'Failed' else 'Completed' end as status,
        cast(floor(l_extendedprice / 1000) as bigint) as amount, cast(l_quantity as bigint) as fee, cast(date_trunc('year', l_shipdate) as date) as file_day, cast(l_suppkey as varchar) as store_number,
        'Shop~ ' || l_suppkey as party_name, l_partkey from lineitem""",
    "matched": """select distinct t.*, c.contract_id, c.principal, c.access_fee, c.product_code, c.identity from txns t join contracts c on t.loan_contract_id = c.contract_id
        and (t.amount = c.principal or t.amount - t.fee = c.principal) where t.is_disbursement and t.status = 'Completed'""",
    "shared": "select surrogate_id as warehouse_key from txns where l_partkey % 3 = 0",
    "statement": """select l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as statement_id, 'T' || l_orderkey || '-' || l_linenumber as receipt_number,
        case when l_returnflag = 'R' then 'Failed' else 'Completed' end as transaction_status, case when l_tax > 0 then 'Disbursement to ' || l_suppkey || ' - Outlet' else 'Transfer' end as details,
        case l_linenumber % 5 when 0 then 'Fee charge' when 1 then '1 day loan' when 2 then '7 day loan' when 3 then '21 day loan' else '30 day loan' end as reason_type, -l_extendedprice as withdrawn,
        l_extendedprice as paid_in, l_linestatus = 'F' as is_repayment, l_suppkey || ' - Outlet' as other_party, l_shipdate as completed_at, l_partkey, l_suppkey from lineitem""",
})


def _log(spark, d):
    """Events as the request log of the live feed, payloads doubly encoded."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    inner = F.concat(F.lit('{"receipt_number":"R'), (F.col("event_id") % 3000).cast("string"), F.lit('","shop":'), F.col("user_id").cast("string"),
                     F.lit(',"amount":'), money("value").cast("string"), F.lit(',"initiated":"'), F.date_format("ts", "yyyyMMddHHmmss"), F.lit('"}'))
    menu = F.when(F.col("event_type") == "purchase", "loan_request").when(F.col("event_type") == "click", "loan_repayment").when(F.col("event_type") == "signup", "opt_in").otherwise("other")
    return e.select(F.col("event_id").alias("log_id"), menu.alias("menu"), F.when(k < 50, 200).otherwise(400).alias("status_code"), F.col("ts").alias("request_time"), inner.alias("raw_request"))


_FEED = "receipt_number string, shop bigint, amount decimal(18,2), initiated string"


def _feed_missing(spark, d, menu):
    feed = recon.feed_rows(_log(spark, d), menu, _FEED)
    core = loans(spark, d).filter("loan_status = 600").select(F.concat(F.lit("R"), F.col("loan_id").cast("string")).alias("receipt_number"))
    already = repayments(spark, d).filter("line = 7").select(F.concat(F.lit("R"), F.col("loan_id").cast("string")).alias("receipt_number"))
    out = recon.feed_missing(feed, core, already, "receipt_number", {"receipt_number": "receipt_number", "store_number": "shop", "amount": "amount"}, "initiated")
    return out.withColumns({"amount": F.col("amount").cast("double"), "status_code": F.col("status_code").cast("long"), "initiated_at": F.col("initiated_at").cast("timestamp_ntz")})


_FEED_SQL = """
with f as (select *, row_number() over (partition by receipt, status_code order by ts desc, log_id desc) as r from log where menu = '{menu}'
  and receipt not in (select 'R' || loan_id from loans where loan_status = 600) and receipt not in (select 'R' || loan_id from repayments where line = 7))
select receipt as receipt_number, shop as store_number, cast(amount as double) as amount, cast(status_code as bigint) as status_code, date_trunc('second', ts) as initiated_at, 'feed' as src from f where r = 1"""


@query("feed_disbursements_missing", _FEED_SQL.format(menu="loan_request"), ("loans", "repayments", "log"))
def feed_disbursements_missing(spark, d):
    return _feed_missing(spark, d, "loan_request")


@query("feed_repayments_missing", _FEED_SQL.format(menu="loan_repayment"), ("loans", "repayments", "log"))
def feed_repayments_missing(spark, d):
    return _feed_missing(spark, d, "loan_repayment")


@query("feed_opt_ins_missing", """
with f as (select shop, ts, log_id, status_code, row_number() over (partition by shop, status_code order by ts desc, log_id desc) as r from log where menu = 'opt_in' and shop not in (select client_id from clients where segment = 'BUILDING'))
select shop as store_number, cast(status_code as bigint) as status_code, date_trunc('second', ts) as initiated_at, 'feed' as src from f where r = 1""", ("clients", "log"))
def feed_opt_ins_missing(spark, d):
    feed = recon.feed_rows(_log(spark, d), "opt_in", _FEED).drop("receipt_number").withColumnRenamed("shop", "store")
    known = clients(spark, d).filter("segment = 'BUILDING'").select(F.col("client_id").alias("receipt_number"))
    out = recon.feed_missing(feed, known, known, "store", {"store_number": "store"}, "initiated")
    return out.withColumns({"status_code": F.col("status_code").cast("long"), "initiated_at": F.col("initiated_at").cast("timestamp_ntz")})


def _contracts(spark, d):
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    text = lambda c: c.cast("string")
    return o.select(k.alias("surrogate_id"), F.concat(F.lit("K"), text(k)).alias("contract_id"), F.concat(F.lit("I"), text(k % 1000)).alias("identity"),
                    F.date_format(F.trunc(F.to_date("o_orderdate"), "YEAR"), "yyyyMMdd").alias("id_date"), F.floor(F.col("o_totalprice") / 1000).alias("principal"),
                    (F.col("o_custkey") % 100).alias("access_fee"), F.concat(F.lit("1000"), text(1 + k % 4)).alias("product_code"))


def _txns(spark, d):
    text = lambda c: c.cast("string")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    pair = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return table(spark, d, "lineitem").select(
        key.alias("surrogate_id"), F.concat(F.lit("X"), pair).alias("transaction_id"), F.concat(F.lit("T"), pair).alias("linked_id"),
        F.when(F.col("l_partkey") % 10 != 0, F.concat(F.lit("K"), text(F.col("l_orderkey")))).alias("loan_contract_id"), F.concat(F.lit("I"), text(F.col("l_orderkey") % 1000)).alias("owner_id"),
        (F.col("l_linestatus") == "O").alias("is_disbursement"), (F.col("l_linestatus") == "F").alias("is_repayment"), F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Completed").alias("status"),
        F.floor(F.col("l_extendedprice") / 1000).alias("amount"), F.col("l_quantity").cast("long").alias("fee"), F.trunc(F.to_date("l_shipdate"), "YEAR").alias("file_day"),
        text(F.col("l_suppkey")).alias("store_number"), F.concat(F.lit("Shop~ "), text(F.col("l_suppkey"))).alias("party_name"), F.col("l_partkey"))


def _shared(spark, d):
    return _txns(spark, d).filter("l_partkey % 3 = 0").select(F.col("surrogate_id").alias("warehouse_key"))


@query("dump_disbursements", """
select surrogate_id as warehouse_key, linked_id as receipt_number, file_day as initiated_on, principal as loan_principal, store_number || ' - ' || replace(party_name, '~', '') as other_party, store_number,
  cast(case product_code when '10001' then 1 when '10002' then 7 when '10003' then 21 end as double) as loan_term, 'dump' as src from matched where surrogate_id not in (select warehouse_key from shared)""", ("contracts", "txns", "matched", "shared"))
def dump_disbursements(spark, d):
    return recon.dump_disbursements(_txns(spark, d), _contracts(spark, d), _shared(spark, d)).withColumn("loan_term", F.col("loan_term").cast("double"))


@query("dump_repayments", """
with p as (select * from (select *, rank() over (partition by transaction_id, linked_id order by surrogate_id) as r from txns where is_repayment and status = 'Completed') where r = 1),
g as (select contract_id, identity, min(trim(linked_id)) as loan_ref from matched where identity = owner_id group by 1, 2)
select surrogate_id as warehouse_key, loan_ref, linked_id as receipt_number, file_day as initiated_on, amount as paid_in, store_number, 'dump' as src
from p left join g on p.loan_contract_id = g.contract_id and p.owner_id = g.identity where surrogate_id not in (select warehouse_key from shared)""", ("contracts", "txns", "matched", "shared"))
def dump_repayments(spark, d):
    return recon.dump_repayments(_txns(spark, d), _contracts(spark, d), _shared(spark, d))


@query("dump_opt_ins", """
with a as (select o_orderkey as surrogate_id, case when o_custkey % 17 = 0 then '-1' else cast(o_custkey as varchar) end as store_number, cast(o_orderdate as date) as opt_in_date, case when o_orderkey % 2 = 0 then 'N' || o_orderkey end as id_number,
  ' I' || o_orderkey as identity, o_orderpriority as nm from orders where o_orderstatus <> 'P'),
r as (select *, rank() over (partition by store_number order by opt_in_date desc, surrogate_id desc) as k from a where store_number <> '-1')
select surrogate_id as warehouse_key, store_number, nm as first_name, nm as business_name, coalesce(id_number, trim(identity)) as national_id, '2547' || surrogate_id as phone, opt_in_date as registered_on from r
where k = 1 and surrogate_id not in (select loan_id from repayments where line = 7)""", ("repayments",))
def dump_opt_ins(spark, d):
    o = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    activity = o.select(
        F.col("o_orderkey").alias("surrogate_id"), F.when(F.col("o_custkey") % 17 == 0, " -1").otherwise(F.col("o_custkey").cast("string")).alias("store_number"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("opt_in_date"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("N"), key)).alias("id_number"),
        F.concat(F.lit(" I"), key).alias("identity"), F.concat(F.lit("~"), F.col("o_orderpriority")).alias("entity_name"), F.concat(F.lit(" ¿"), F.col("o_orderpriority")).alias("customer_name"),
        F.concat(F.lit("2547"), key, F.lit(".0")).alias("phone"))
    already = repayments(spark, d).filter("line = 7").select(F.col("loan_id").alias("warehouse_key"))
    return recon.dump_opt_ins(activity, already)


@query("missing_in_core", "select surrogate_id, linked_id, amount from txns where loan_contract_id is null or loan_contract_id not in (select contract_id from contracts where access_fee < 50)", ("contracts", "txns"))
def missing_in_core(spark, d):
    core = _contracts(spark, d).filter("access_fee < 50")
    return missing_from(_txns(spark, d).select("surrogate_id", "linked_id", "amount", "loan_contract_id"), (core, "loan_contract_id", "contract_id")).drop("loan_contract_id")


@query("contract_check", """
with u as (select * exclude (rn) from (select *, row_number() over (partition by linked_id, loan_contract_id, owner_id, status, amount, fee, file_day, store_number, party_name, l_partkey order by surrogate_id) as rn from txns where is_disbursement and status = 'Completed') where rn = 1),
a as (select distinct linked_id, c.contract_id as a from u left join contracts c on u.loan_contract_id = c.contract_id and u.owner_id = c.identity and c.access_fee = u.fee),
b as (select distinct linked_id, c.contract_id as b from u left join contracts c on u.owner_id = c.identity and strftime(u.file_day, '%Y%m%d') = c.id_date and u.amount = c.principal + c.access_fee)
select linked_id, min(a) as contract_id_a, min(b) as contract_id_b, bool_or(a is not distinct from b) as agrees from a join b using (linked_id) where b is not null group by 1""", ("contracts", "txns"))
def contract_check(spark, d):
    return recon.contract_check(_txns(spark, d), _contracts(spark, d))


def _statement(spark, d):
    text = lambda c: F.col(c).cast("string")
    k = F.col("l_linenumber") % 5
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("statement_id"), F.concat(F.lit("T"), text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("receipt_number"),
        F.when(F.col("l_returnflag") == "R", "Failed").otherwise("Completed").alias("transaction_status"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("Disbursement to "), text("l_suppkey"), F.lit(" - Outlet"))).otherwise("Transfer").alias("details"),
        F.when(k == 0, "Fee charge").when(k == 1, "1 day loan").when(k == 2, "7 day loan").when(k == 3, "21 day loan").otherwise("30 day loan").alias("reason_type"),
        (-F.col("l_extendedprice")).alias("withdrawn"), F.col("l_extendedprice").alias("paid_in"), (F.col("l_linestatus") == "F").alias("is_repayment"),
        F.concat(text("l_suppkey"), F.lit(" - Outlet")).alias("other_party"), F.col("l_shipdate").alias("completed_at"), F.col("l_partkey"))


@query("statement_disbursements", """
select statement_id as warehouse_key, receipt_number, case split_part(reason_type, ' ', 1) when '1' then withdrawn * -1 * 100 / 99.52::double when '7' then withdrawn * -1 * 100 / 96.88::double
  when '21' then withdrawn * -1 * 100 / 90.88::double else withdrawn end as loan_principal, other_party, cast(l_suppkey as varchar) as store_number, split_part(reason_type, ' ', 1) as loan_term from statement
where transaction_status = 'Completed' and details like '%Disbursement%' and completed_at > timestamp '2000-01-01' and not regexp_matches(reason_type, '^[A-Za-z]') and l_partkey % 3 <> 0""", ("statement",))
def statement_disbursements(spark, d):
    s = _statement(spark, d)
    already = s.filter("l_partkey % 3 = 0").select(F.col("statement_id").alias("warehouse_key"))
    return recon.statement_disbursements(s, already, dt.datetime(2000, 1, 1))


@query("statement_repayments", """
with f as (select linked_id, loan_contract_id from (select *, rank() over (partition by linked_id order by surrogate_id) as r from txns where is_repayment) where r = 1 and status = 'Completed'),
j as (select s.receipt_number, s.statement_id, 'L' || substr(loan_contract_id, 2) as loan_ref, paid_in, l_suppkey from statement s join f on s.receipt_number = f.linked_id
  join contracts on contract_id = loan_contract_id where s.is_repayment and s.transaction_status = 'Completed' and l_partkey % 3 <> 0)
select receipt_number, m.s as warehouse_key, m.l as loan_ref, m.p as paid_in, m.n as store_number
from (select receipt_number, max({'s': statement_id, 'l': loan_ref, 'p': paid_in, 'n': l_suppkey}) as m from j group by 1)""", ("contracts", "txns", "statement"))
def statement_repayments(spark, d):
    s = _statement(spark, d)
    already = s.filter("l_partkey % 3 = 0").select(F.col("statement_id").alias("warehouse_key"))
    core = _contracts(spark, d).select("contract_id", F.concat(F.lit("L"), F.substring("contract_id", 2, 20)).alias("receipt_number"))
    return recon.statement_repayments(s, _txns(spark, d), core, already)


@query("closed_contract_differences", """
with c as (select loan_id, count(*) as n, sum(amount + fee * 5) as paid, sum(fee) as fees, max(paid_on) as closed_on, max({'c': paid_on, 'p': case when line > 3 then 'Loan 7-21' else 'Loan 30 days' end}) as p from repayments where flag = 'A' group by 1)
select loan_id as contract_id, cast(paid as double) as repaid_theirs, closed_on, cast(greatest(paid - principal, 0) as double) as missing_repayment, cast(greatest(principal - paid, 0) as double) as over_repayment,
  cast(greatest(fees - 20, 0) as double) as missing_penalty, cast(greatest(20 - fees, 0) as double) as over_penalty,
  cast(date '2001-08-01' - (p.c + case when p.p = 'Loan 7-21' then 7 else 30 end) as bigint) as days_late_theirs, cast(greatest(date '2001-08-01' - matures_on, 0) as bigint) as days_late_ours
from c join loans using (loan_id) where loan_status = 300""", ("loans", "repayments"))
def closed_contract_differences(spark, d):
    fee = F.col("fee")
    closed = repayments(spark, d).filter("flag = 'A'").select(
        F.col("loan_id").alias("contract_id"), F.col("amount").alias("principal"), fee.alias("access_fee"), fee.alias("interest_fee"), fee.alias("maintenance_fee"), fee.alias("rollover_fee"),
        fee.alias("penalty_fee"), F.col("paid_on").alias("closed_on"), F.col("paid_on").alias("created_on"), F.when(F.col("line") > 3, "Loan 7-21").otherwise("Loan 30 days").alias("product_name"))
    core = loans(spark, d).select(F.col("loan_id").alias("contract_id"), "loan_status", F.col("principal").alias("repaid"), F.lit(20).alias("penalty"), F.lit(10).alias("interest"),
                                  F.lit(5).alias("fees"), "matures_on")
    out = recon.closed_differences(closed, core, dt.date(2001, 8, 1))
    return out.select("contract_id", F.col("repaid_theirs").cast("double").alias("repaid_theirs"), "closed_on", *[F.col(c).cast("double").alias(c) for c in (
        "missing_repayment", "over_repayment", "missing_penalty", "over_penalty")], "days_late_theirs", "days_late_ours")


@query("contract_differences", """
with p as (select loan_id, sum(amount) as paid from repayments group by 1)
select loan_id, cast(greatest(paid - principal, 0) as double) as missing_value, cast(greatest(principal - paid, 0) as double) as over_value from loans join p using (loan_id)""", ("loans", "repayments"))
def contract_differences(spark, d):
    from ledgerloom.operators.aggregate import signed_differences
    paid = repayments(spark, d).groupBy("loan_id").agg(F.sum("amount").alias("paid"))
    out = signed_differences(loans(spark, d).join(paid, "loan_id"), {"value": ("paid", "principal")})
    return out.select("loan_id", F.col("missing_value").cast("double").alias("missing_value"), F.col("over_value").cast("double").alias("over_value"))


@query("balance_discrepancies", """
with l as (select loan_id, max(paid_on) as last_on from repayments group by 1)
select loan_id, cast(principal - 100000 as double) as variance, cast(last_on - matures_on as bigint) as days_between, last_on as latest_repayment from loans join l using (loan_id)
where loan_status = 300 and principal >= 100000 and matures_on < last_on""", ("loans", "repayments"))
def balance_discrepancies(spark, d):
    book = loans(spark, d).withColumns({"partner_balance": F.col("principal"), "total_outstanding": F.lit(100000), "partner_balance_date": F.col("matures_on")})
    out = recon.balance_discrepancies(book, repayments(spark, d))
    return out.select("loan_id", F.col("variance").cast("double").alias("variance"), "days_between", "latest_repayment")


@query("posting_feedback", """
with b as (select client_id, arg_min(s, {'o': coalesce(s, '9'), 'r': f}) as s, arg_min(f, {'o': coalesce(s, '9'), 'r': f}) as f from (
  select client_id, case loan_status when 600 then '200' when 300 then '400' end as s, 'reason ' || channel as f from loans where loan_id % 2 = 0) group by 1),
d as (select client_id, case client_id % 3 when 0 then null when 1 then '400' else '200' end as s, case when client_id % 4 = 0 then 'old reason' end as f from clients)
select d.client_id, case when d.s is null or (d.f is null and d.s <> '200') then coalesce(b.s, d.s) else d.s end as status_code,
  case when d.s is null or (d.f is null and d.s <> '200') then coalesce(b.f, d.f) else d.f end as failure_reason from d left join b using (client_id)""", ("clients", "loans"))
def posting_feedback(spark, d):
    k = F.col("client_id") % 3
    dump = clients(spark, d).select("client_id", F.when(k == 0, F.lit(None)).when(k == 1, "400").otherwise("200").alias("status_code"),
                                    F.when(F.col("client_id") % 4 == 0, "old reason").alias("failure_reason"))
    posted = loans(spark, d).select("client_id", F.when(F.col("loan_status") == 600, "200").when(F.col("loan_status") == 300, "400").alias("status_code"),
                                    F.concat(F.lit("reason "), F.col("channel")).alias("failure_reason"), F.when(F.col("loan_id") % 2 == 0, F.col("loan_id")).alias("warehouse_key"))
    return recon.feedback(dump, posted, "client_id")


def _monthly_sides(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", 2).otherwise(1).alias("transaction_type"), F.to_date("l_shipdate").alias("transaction_date"), money("l_extendedprice").alias("amount"),
        F.when(F.col("l_tax") > 0, money("l_quantity")).alias("penalty"), F.col("l_linenumber"), F.col("l_quantity"))
    return rows, rows.filter(~((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45)) & (F.col("transaction_date") >= F.lit(dt.date(1995, 3, 1))))


_SIDES = """
with r as (select cast(l_shipdate as date) as dd, cast(l_extendedprice as decimal(18,2)) as a, case when l_tax > 0 then cast(l_quantity as decimal(18,2)) end as p, l_linenumber as n, l_quantity as q from lineitem),
c as (select cast(year(dd) as bigint) as year, cast(month(dd) as bigint) as month, count(*) as cnt, sum(a) as s, coalesce(sum(p), 0) as p from r group by 1, 2),
w as (select cast(year(dd) as bigint) as year, cast(month(dd) as bigint) as month, count(*) as cnt, sum(a) as s, coalesce(sum(p), 0) as p from r where not (n = 7 and q > 45) and dd >= date '1995-03-01' group by 1, 2)
"""


def _reconciled(spark, d, how):
    out = monitoring.transactions(*_monthly_sides(spark, d), how=how)
    fixed = {c: F.col(c).cast("double") for c in out.columns if "sum" in c}
    return out.withColumns({"year": F.col("year").cast("long"), "month": F.col("month").cast("long"), **fixed})


@query("reconcile_monthly", _SIDES + """
select year, month, c.cnt as total_count_core, w.cnt as total_count_warehouse, c.cnt - w.cnt as diff_total_count, cast(c.s as double) as total_sum_core, cast(w.s as double) as total_sum_warehouse, cast(c.s - w.s as double) as diff_total_sum,
  cast(c.p as double) as penalty_sum_core, cast(w.p as double) as penalty_sum_warehouse, cast(c.p - w.p as double) as diff_penalty_sum from c join w using (year, month)""")
def reconcile_monthly(spark, d):
    return _reconciled(spark, d, "inner")


@query("reconcile_monthly_full", _SIDES + """
select year, month, c.cnt as total_count_core, coalesce(w.cnt, 0) as total_count_warehouse, c.cnt - coalesce(w.cnt, 0) as diff_total_count, cast(c.s as double) as total_sum_core, cast(coalesce(w.s, 0) as double) as total_sum_warehouse,
  cast(c.s - coalesce(w.s, 0) as double) as diff_total_sum, cast(c.p as double) as penalty_sum_core, cast(coalesce(w.p, 0) as double) as penalty_sum_warehouse, cast(c.p - coalesce(w.p, 0) as double) as diff_penalty_sum from c left join w using (year, month)""")
def reconcile_monthly_full(spark, d):
    return _reconciled(spark, d, "full")


@query("backfill_months", _SIDES + "select year, month from c join w using (year, month) where (c.cnt <> w.cnt or c.s <> w.s or c.p <> w.p) and (year < 2001 or (year = 2001 and month < 8))")
def backfill_months(spark, d):
    return monitoring.backfill_months(_reconciled(spark, d, "inner"), "2001-08-15")


@query("reload_months", """
with core as (select loan_id, line, paid_on, cast(amount as decimal(18,4)) as amount, line = 1 as on_time, year(paid_on) as year, month(paid_on) as month from repayments),
stored as (select loan_id, line, paid_on, case when year = 2000 and month = 5 then amount + 1 else amount end as amount, year, month from core
  where not (month = 3 and line = 2) and not (year = 1999 and month = 7) and not (year = 2001 and month >= 8 and line = 1)),
a as (select year, month, count(*) as n, sum(amount) as s from core group by 1, 2), b as (select year, month, count(*) as n, sum(amount) as s from stored group by 1, 2),
again as (select year, month from a join b using (year, month) where (a.n <> b.n or a.s <> b.s) and (year < 2001 or year = 2001 and month < 8))
select loan_id, line, paid_on, cast(amount as double) as amount from core where (year, month) in (select (year, month) from again)
union all select loan_id, line, paid_on, cast(amount as double) from stored where (year, month) not in (select (year, month) from again)""", ("repayments",))
def reload_months(spark, d):
    """A stored table with months that lack rows or differ: those before the current month are loaded again, in place."""
    core = repayments(spark, d).select("loan_id", "line", "paid_on", F.col("amount").cast("decimal(18,4)").alias("amount"))
    year, month = F.year("paid_on"), F.month("paid_on")
    lost = ((month == 3) & (F.col("line") == 2)) | ((year == 1999) & (month == 7)) | ((year == 2001) & (month >= 8) & (F.col("line") == 1))
    path = shared_dir(spark, "transactions")
    stored = core.filter(~lost).withColumn("amount", F.when((year == 2000) & (month == 5), F.col("amount") + 1).otherwise(F.col("amount")).cast("decimal(18,4)"))
    sinks.overwrite(stored.withColumns({"year": F.year("paid_on"), "month": F.month("paid_on")}).hint("rebalance", "year", "month"), path, ["year", "month"])
    held = spark.read.parquet(path)
    extra = {"transaction_type": F.lit(1), "penalty": F.lit(0), "transaction_date": F.col("paid_on")}
    report = monitoring.transactions(core.withColumns(extra), held.withColumns(extra))
    monitoring.reload_months(core, report, path, "paid_on", "2001-08-15")
    return spark.read.parquet(path).select("loan_id", "line", "paid_on", F.col("amount").cast("double").alias("amount"))


@query("reconcile_clients", """
with f as (select client_id, min(disbursed_on) as d from loans group by 1), g as (select * from f where client_id % 7 <> 0)
select year, month, a.n as total_count_core, b.n as total_count_warehouse, a.n - b.n as diff_total_count from (select cast(year(d) as bigint) as year, cast(month(d) as bigint) as month, count(*) as n from f group by 1, 2) a
join (select cast(year(d) as bigint) as year, cast(month(d) as bigint) as month, count(*) as n from g group by 1, 2) b using (year, month)""", ("loans",))
def reconcile_clients(spark, d):
    first = loans(spark, d).groupBy("client_id").agg(F.min("disbursed_on").alias("submitted_on"))
    out = monitoring.clients(first, first.filter("client_id % 7 <> 0"))
    return out.withColumns({"year": F.col("year").cast("long"), "month": F.col("month").cast("long")})


@query("reconcile_loans", """
with l as (select *, principal / 2 as o, cast(year(disbursed_on) as bigint) as year, cast(month(disbursed_on) as bigint) as month from loans)
select year, month, a.n as total_count_core, b.n as total_count_warehouse, a.n - b.n as diff_total_count, cast(a.p as double) as principal_sum_core, cast(b.p as double) as principal_sum_warehouse,
  a.c3 - b.c3 as diff_count_active, a.c6 - b.c6 as diff_count_closed from (select year, month, count(*) as n, sum(principal) as p, count(*) filter (where loan_status = 300) as c3, count(*) filter (where loan_status = 600) as c6 from l group by 1, 2) a
join (select year, month, count(*) as n, sum(principal) as p, count(*) filter (where loan_status = 300) as c3, count(*) filter (where loan_status = 600) as c6 from l where loan_id % 10 <> 0 group by 1, 2) b using (year, month)""", ("loans",))
def reconcile_loans(spark, d):
    rows = loans(spark, d).withColumn("total_outstanding", F.col("principal"))
    out = monitoring.loans(rows, rows.filter("loan_id % 10 <> 0"))
    return out.select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "total_count_core", "total_count_warehouse", "diff_total_count",
                      F.col("principal_sum_core").cast("double").alias("principal_sum_core"), F.col("principal_sum_warehouse").cast("double").alias("principal_sum_warehouse"),
                      "diff_count_active", "diff_count_closed")


@query("reconcile_whitelist", """
with p as (select count(*) filter (where client_id % 2 = 1) as b, count(*) filter (where client_id % 2 = 0) as w, sum(client_id % 1000) as l1 from clients),
r as (select count(*) filter (where loan_id % 2 = 1) as b, count(*) filter (where loan_id % 2 = 0) as w, sum(loan_id % 1000) as l1 from loans where channel = (select max(channel) from loans))
select p.b as blacklisted_partner, r.b as blacklisted_warehouse, r.b - p.b as diff_blacklisted, r.w - p.w as diff_whitelisted, cast(r.l1 - p.l1 as double) as diff_limit_1 from p, r""", ("clients", "loans"))
def reconcile_whitelist(spark, d):
    limits = lambda k: [(F.col(k) % 2).alias("blacklist_flag"), (F.col(k) % 1000).alias("limit_1"), (F.col(k) % 700).alias("limit_7"), (F.col(k) % 300).alias("limit_21")]
    out = monitoring.whitelist(clients(spark, d).select(limits("client_id")), loans(spark, d).select(*limits("loan_id"), F.col("channel").alias("model_version")))
    return out.select("blacklisted_partner", "blacklisted_warehouse", "diff_blacklisted", "diff_whitelisted", F.col("diff_limit_1").cast("double").alias("diff_limit_1"))


@query("settled_at_partner", "select loan_id, client_id, cast(principal as double) / 2 as principal_outstanding from loans where loan_status = 300 and loan_id % 3 = 0", ("loans",))
def settled_at_partner(spark, d):
    book = loans(spark, d).withColumns({"partner_balance": F.when(F.col("loan_id") % 3 == 0, 0.0).when(F.col("loan_id") % 3 == 1, F.col("principal").cast("double")),
                                        "principal_outstanding": F.col("principal").cast("double") / 2})
    return recon.settled_at_partner(book).select("loan_id", "client_id", "principal_outstanding")
