"""Join types, as-of, spine, reconciliation and presence."""
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import clients, loans, query, repayments, table
from ledgerloom.operators import joins, merge


@query("inner_join", "select loan_id, client_id, client_name, segment, cast(principal as double) as principal from loans join clients using (client_id)", ("loans", "clients"))
def inner_join(spark, d):
    return loans(spark, d).join(clients(spark, d), "client_id").select(
        "loan_id", "client_id", "client_name", "segment", F.col("principal").cast("double").alias("principal"))


@query("left_join", """
select c.client_id, l.loan_id, l.channel from clients c left join (select * from loans where loan_status = 300 and principal > 400000) l using (client_id)""", ("loans", "clients"))
def left_join(spark, d):
    big = loans(spark, d).filter("loan_status = 300 and principal > 400000").select("client_id", "loan_id", "channel")
    return clients(spark, d).select("client_id").join(big, "client_id", "left")


@query("right_join", """
select c.client_name, l.loan_id, l.client_id from (select * from clients where segment = 'BUILDING') c right join loans l on c.client_id = l.client_id""", ("loans", "clients"))
def right_join(spark, d):
    some = clients(spark, d).filter("segment = 'BUILDING'").select("client_id", "client_name")
    return some.join(loans(spark, d).select("loan_id", "client_id"), "client_id", "right").select("client_name", "loan_id", "client_id")


@query("full_join", """
with a as (select paid_on as day, count(*) as n_paid from repayments where flag = 'R' and line = 1 group by 1),
b as (select disbursed_on as day, count(*) as n_given from loans where loan_status = 300 group by 1)
select day, cast(n_paid as double) as n_paid, cast(n_given as double) as n_given from a full join b using (day)""", ("loans", "repayments"))
def full_join(spark, d):
    a = repayments(spark, d).filter("flag = 'R' and line = 1").groupBy(F.col("paid_on").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n_paid"))
    b = loans(spark, d).filter("loan_status = 300").groupBy(F.col("disbursed_on").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("n_given"))
    return a.join(b, "day", "full")


@query("semi_join", "select loan_id, line, staff_id, paid_on from repayments where loan_id in (select loan_id from loans where loan_status = 700)", ("loans", "repayments"))
def semi_join(spark, d):
    return merge.keep_known(repayments(spark, d).select("loan_id", "line", "staff_id", "paid_on"), loans(spark, d).filter("loan_status = 700"), "loan_id")


@query("anti_join", "select loan_id, client_id from loans l where not exists (select 1 from repayments r where r.loan_id = l.loan_id)", ("loans", "repayments"))
def anti_join(spark, d):
    return joins.missing_from(loans(spark, d).select("loan_id", "client_id"), (repayments(spark, d), "loan_id", "loan_id"))


@query("failed_never_succeeded", """
select distinct loan_id, line from repayments a where flag = 'R' and not exists (
  select 1 from repayments b where b.flag <> 'R' and b.loan_id = a.loan_id and b.line = a.line)""", ("repayments",))
def failed_never_succeeded(spark, d):
    rows = repayments(spark, d).select("loan_id", "line", "flag")
    done = rows.filter("flag <> 'R'").select("loan_id", "line").distinct()
    return rows.filter("flag = 'R'").select("loan_id", "line").distinct().join(done, ["loan_id", "line"], "left_anti")


@query("contract_match", """
select r.loan_id, r.line, r.part_id, r.staff_id, l.client_id from repayments r join loans l on r.loan_id = l.loan_id
  and (r.amount - 50000 <= l.principal * 0.1 or r.fee = 50)""", ("loans", "repayments"))
def contract_match(spark, d):
    """Equal contract id, plus a residual with an OR that only filters."""
    a, b = repayments(spark, d), loans(spark, d).select(F.col("loan_id").alias("contract_id"), "client_id", "principal")
    near = (F.col("amount") - 50000 <= F.col("principal") * F.lit("0.1").cast("decimal(2,1)")) | (F.col("fee") == 50)
    return a.join(b, (F.col("loan_id") == F.col("contract_id")) & near).select("loan_id", "line", "part_id", "staff_id", "client_id")


@query("derived_keys", """
select r.loan_id, r.line, r.part_id, r.staff_id, l.loan_id as same_day_loan from repayments r join loans l
  on strftime(r.paid_on, '%Y%m%d') = strftime(l.disbursed_on, '%Y%m%d') and r.loan_id + r.line = l.loan_id""", ("loans", "repayments"))
def derived_keys(spark, d):
    """Format and arithmetic conditions become key columns of a plain join."""
    a = repayments(spark, d).select("loan_id", "line", "part_id", "staff_id", F.date_format("paid_on", "yyyyMMdd").alias("day_key"),
                                    (F.col("loan_id") + F.col("line")).alias("sum_key"))
    b = loans(spark, d).select(F.date_format("disbursed_on", "yyyyMMdd").alias("day_key"), F.col("loan_id").alias("sum_key"),
                               F.col("loan_id").alias("same_day_loan"))
    return a.join(b, ["day_key", "sum_key"]).select("loan_id", "line", "part_id", "staff_id", "same_day_loan")


@query("asof_version", """
with versions as (select date_trunc('month', disbursed_on)::date + 14 as end_date, max('v' || loan_id) as model_version from loans group by 1)
select l.loan_id, l.disbursed_on, v.model_version from loans l asof left join versions v on l.disbursed_on > v.end_date""", ("loans",))
def asof_version(spark, d):
    """No join key: loans and versions travel along one time line."""
    ends = F.date_add(F.trunc("disbursed_on", "MM"), 14)
    versions = loans(spark, d).groupBy(ends.alias("end_date")).agg(F.max(F.concat(F.lit("v"), F.col("loan_id").cast("string"))).alias("model_version"))
    return joins.asof_join(loans(spark, d).select("loan_id", "disbursed_on"), versions, "disbursed_on", "end_date", "model_version")


@query("asof_by_key", """
with marks as (select loan_id, paid_on, max(staff_id) as staff_id from repayments group by 1, 2)
select l.loan_id, l.matures_on, cast(m.staff_id as double) as staff_id from loans l asof left join marks m on l.loan_id = m.loan_id and l.matures_on >= m.paid_on""", ("loans", "repayments"))
def asof_by_key(spark, d):
    out = joins.asof_join(loans(spark, d).select("loan_id", "matures_on"), repayments(spark, d), "matures_on", "paid_on", "staff_id",
                          by=["loan_id"], strict=False, slices=4)
    return out.select("loan_id", "matures_on", F.col("staff_id").cast("double").alias("staff_id"))


@query("constant_lookup", """
select loan_id, r_name as region from loans, (select r_name from region where r_regionkey = 2)""", ("loans",))
def constant_lookup(spark, d):
    """A condition on constants: every row gets the one lookup value."""
    one = table(spark, d, "region").filter("r_regionkey = 2").agg(F.max("r_name")).scalar()
    return loans(spark, d).select("loan_id", one.alias("region"))


@query("spine_report", """
with days as (select cast(unnest(generate_series(date '2001-07-02', date '2001-08-01', interval 1 day)) as date) as day),
a as (select disbursed_on as day, count(*) as n_given, cast(sum(principal) as double) as given from loans group by 1),
b as (select paid_on as day, count(*) as n_paid, cast(sum(amount) as double) as paid from repayments group by 1)
select day, coalesce(n_given, 0) as n_given, coalesce(given, 0) as given, coalesce(n_paid, 0) as n_paid, coalesce(paid, 0) as paid
from days left join a using (day) left join b using (day)""", ("loans", "repayments"))
def spine_report(spark, d):
    """Both feeds are cut to the window, stacked, and aggregated once."""
    window = lambda c: F.col(c).between(F.lit("2001-07-02").cast("date"), F.lit("2001-08-01").cast("date"))
    given = loans(spark, d).filter(window("disbursed_on")).select(F.col("disbursed_on").alias("day"), F.lit(1).alias("g"), F.lit(0).alias("p"),
                                                                  F.col("principal").cast("decimal(18,4)").alias("gv"), F.lit(0).cast("decimal(18,4)").alias("pv"))
    paid = repayments(spark, d).filter(window("paid_on")).select(F.col("paid_on").alias("day"), F.lit(0).alias("g"), F.lit(1).alias("p"),
                                                                 F.lit(0).cast("decimal(18,4)").alias("gv"), F.col("amount").cast("decimal(18,4)").alias("pv"))
    daily = given.unionByName(paid).groupBy("day").agg(F.sum("g").alias("n_given"), F.sum("gv").cast("double").alias("given"),
                                                       F.sum("p").alias("n_paid"), F.sum("pv").cast("double").alias("paid"))
    return joins.spine_join(joins.day_spine(spark, F.lit("2001-07-02").cast("date"), F.lit("2001-08-01").cast("date")), daily, "day")


@query("presence_matrix", """
with a as (select loan_id, count(*) as n from loans where loan_status <> 700 group by 1), b as (select loan_id, count(*) as n from repayments where flag = 'R' group by 1),
c as (select loan_id, count(*) as n from repayments where line_status = 'F' group by 1), k as (select loan_id from a union select loan_id from b union select loan_id from c)
select loan_id, a.n is not null as in_core, b.n is not null as in_feed, c.n is not null as in_dump, coalesce(a.n, 0) as n_core, coalesce(b.n, 0) as n_feed, coalesce(c.n, 0) as n_dump
from k left join a using (loan_id) left join b using (loan_id) left join c using (loan_id)""", ("loans", "repayments"))
def presence_matrix(spark, d):
    r = repayments(spark, d)
    return joins.presence_matrix({"core": loans(spark, d).filter("loan_status <> 700"), "feed": r.filter("flag = 'R'"),
                                  "dump": r.filter("line_status = 'F'")}, "loan_id")


@query("rule_agreement", """
with a as (select loan_id, max(staff_id) as answer from repayments group by 1), b as (select loan_id, max(staff_id) as answer from repayments where flag <> 'R' group by 1)
select loan_id, a.answer as answer_a, b.answer as answer_b, a.answer = b.answer as agrees from a join b using (loan_id)""", ("repayments",))
def rule_agreement(spark, d):
    r = repayments(spark, d)
    one = lambda df: df.groupBy("loan_id").agg(F.max("staff_id").alias("answer"))
    return joins.rule_agreement(one(r), one(r.filter("flag <> 'R'")), "loan_id", "answer")


@query("exchange_rates", """
select base, r.n_name as code, cast(x.n_nationkey as bigint) as base_id, cast(r.n_nationkey as bigint) as code_id, cast(rate as double) as rate from (
  select n_name as base, n_nationkey, unnest([{'code': 'NATION_0', 'rate': n_nationkey * 1.5}, {'code': 'NATION_7', 'rate': n_nationkey * 2.5}, {'code': 'NOWHERE', 'rate': 1.0}], recursive := true) from nation) x
  join nation r on r.n_name = x.code""")
def exchange_rates(spark, d):
    from ledgerloom.operators.extract import exchange_rates as explode_rates
    nation = table(spark, d, "nation")
    key = F.col("n_nationkey")
    rates = nation.select(F.col("n_name").alias("base"), F.lit("2024-01-31").alias("date"), F.create_map(
        F.lit("NATION_0"), key * 1.5, F.lit("NATION_7"), key * 2.5, F.lit("NOWHERE"), F.lit(1.0)).alias("rates"))
    out = explode_rates(rates, nation.select(F.col("n_name").alias("code"), F.col("n_nationkey").alias("currency_id")))
    return out.select("base", "code", F.col("base_id").cast("long").alias("base_id"), F.col("code_id").cast("long").alias("code_id"), "rate")
