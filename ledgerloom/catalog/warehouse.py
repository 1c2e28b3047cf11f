"""Extract-load operators: new keys, versions, upserts, audits, child tables."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import clients, loans, query, repayments, table
from ledgerloom.operators import extract, ingest, merge
from ledgerloom.operators.dedupe import latest_per_key
from ledgerloom.operators.extract import Tenant
from ledgerloom.plans import warehouse as plans

TRACKED = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
CUT = dt.datetime(2001, 8, 1)


def _products(spark, d):
    return table(spark, d, "part").select("p_partkey", *TRACKED)


def _product_changes(spark, d):
    """The next delivery of the product list: prices move, some products are new."""
    key = F.col("p_partkey")
    moved = _products(spark, d).withColumn("p_retailprice", F.when(key % 7 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice")))
    return moved.withColumn("p_name", F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("p_name"))).filter(key % 10 != 3)


def _product_versions(spark, d):
    """Stored versions: every product but some, and one expired version each."""
    live = _products(spark, d).filter(F.col("p_partkey") % 10 != 5).withColumns({
        "valid_from": F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz"), "valid_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)})
    old = _products(spark, d).withColumns({
        "p_retailprice": F.col("p_retailprice") - 1, "valid_from": F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz"),
        "valid_to": F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz"), "is_current": F.lit(False)})
    return live.unionByName(old)


_PRODUCT_SQL = """
with incoming as (select p_partkey, case when p_partkey % 11 = 0 then null else p_name end as p_name, p_brand, p_type, p_size,
    case when p_partkey % 7 = 0 then p_retailprice + 1 else p_retailprice end as p_retailprice from part where p_partkey % 10 <> 3),
live as (select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part where p_partkey % 10 <> 5)
"""


@query("new_keys", "select loan_id, client_id from loans where client_id not in (select c_custkey from customer where c_mktsegment = 'BUILDING')", ("loans",))
def new_keys(spark, d):
    return merge.new_keys(loans(spark, d).select("loan_id", "client_id"), clients(spark, d).filter("segment = 'BUILDING'"), "client_id")


@query("new_staff", """
select s_suppkey as core_id, s_name as staff_name, s_acctbal > 5000 as is_loan_officer from supplier where s_suppkey not in (select c_custkey from customer where c_custkey % 2 = 0)""")
def new_staff(spark, d):
    staff = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                               (F.col("s_acctbal") > 5000).cast("int").alias("is_loan_officer"))
    known = clients(spark, d).filter("client_id % 2 = 0").select(F.col("client_id").alias("core_id"))
    return extract.dimension(staff, known, "id", {"id": "core_id", "name": "staff_name"}, ("is_loan_officer",))


@query("new_clients", """
select c_custkey as id, c_name as name, n_name as gender, r_name as client_type, 'status ' || (c_custkey % 3) as status from customer
left join nation on n_nationkey = c_nationkey left join region on r_regionkey = c_custkey % 7
where c_custkey % 3 < 2 and c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""")
def new_clients(spark, d):
    source = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("gender_id"),
        (F.col("c_custkey") % 7 + 1000).alias("client_type_id"), (F.col("c_custkey") % 3).alias("status_enum"))
    codes = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("code_value")).unionByName(
        table(spark, d, "region").select((F.col("r_regionkey") + 1000).cast("long").alias("id"), F.col("r_name").alias("code_value")))
    statuses = table(spark, d, "region").filter("r_regionkey < 2").select(
        F.lit("status_enum").alias("enum_name"), F.col("r_regionkey").alias("enum_id"),
        F.concat(F.lit("status "), F.col("r_regionkey").cast("string")).alias("enum_value"))
    known = loans(spark, d).filter("loan_status = 700").select(F.col("client_id").alias("core_id"))
    return extract.clients(source, codes, statuses, known).select("id", "name", "gender", "client_type", "status")


def _core_transactions(spark, d):
    r = table(spark, d, "lineitem")
    return r.select(
        F.col("l_orderkey").alias("loan_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")).alias("transaction_id"),
        F.when(F.col("l_linestatus") == "F", 2).when(F.col("l_linenumber") == 1, 1).otherwise(3).alias("transaction_type"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_reversed"), (F.col("l_suppkey") % 4).alias("office_id"),
        F.to_date("l_shipdate").alias("transaction_date"), F.col("l_extendedprice").alias("amount"), F.col("l_partkey").alias("payment_id"))


def _payments(spark, d):
    pay = table(spark, d, "part").filter("p_size <= 25").select(
        F.col("p_partkey").alias("payment_id"), F.col("p_brand").alias("receipt_number"), F.col("p_size").alias("payment_type_id"))
    kinds = table(spark, d, "nation").select(F.col("n_nationkey").alias("payment_type_id"), F.col("n_name").alias("payment_type"))
    return pay, kinds


_TXN_SQL = """
with t as (select l_orderkey as loan_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m%d') as transaction_id,
  case when l_linestatus = 'F' then 2 when l_linenumber = 1 then 1 else 3 end as transaction_type, case when l_returnflag = 'R' then 1 else 0 end as is_reversed,
  l_suppkey % 4 as office_id, cast(l_shipdate as date) as transaction_date, l_extendedprice as amount, l_partkey as payment_id from lineitem)
"""


@query("transactions_extract", _TXN_SQL + """
select t.transaction_id, t.loan_id, t.amount, p.p_brand as receipt_number, n.n_name as payment_type, '2' as version from t join orders on o_orderkey = t.loan_id
join part p on p.p_partkey = t.payment_id and p.p_size <= 25 left join nation n on n.n_nationkey = p.p_size
where transaction_type in (1, 2) and is_reversed = 0 and office_id = 1""")
def transactions_extract(spark, d):
    tenant = Tenant("wholesale", 1, "2", payment_required=True)
    out = extract.transactions(tenant, loans(spark, d), _core_transactions(spark, d), *_payments(spark, d), is_reversed=False)
    return out.select("transaction_id", "loan_id", "amount", "receipt_number", "payment_type", "version")


@query("transactions_of_month", _TXN_SQL + """
select t.transaction_id, t.loan_id, t.transaction_date, t.amount, p.p_brand as receipt_number, is_reversed = 1 as is_reversed from t join orders on o_orderkey = t.loan_id
left join part p on p.p_partkey = t.payment_id and p.p_size <= 25
where transaction_type in (1, 2) and office_id = 2 and transaction_date between date '2000-02-01' and date '2000-02-29'""")
def transactions_of_month(spark, d):
    tenant = Tenant("retail", 2)
    valid, gone = extract.transactions_of_month(tenant, loans(spark, d), _core_transactions(spark, d), *_payments(spark, d), 2000, 2)
    return valid.unionByName(gone).select("transaction_id", "loan_id", "transaction_date", "amount", "receipt_number", (F.col("is_reversed") == 1).alias("is_reversed"))


@query("load_transactions", """
with cur as (select o_orderkey as transaction_id, o_totalprice as amount, false as is_reversed from orders where o_orderstatus <> 'O'),
inc as (select o_orderkey as transaction_id, o_totalprice + 1 as amount, o_custkey % 2 as is_reversed, nullif(trim(case when o_custkey % 5 = 0 then '  ' else o_orderpriority end), '') as receipt,
  case when o_custkey % 3 = 0 then 2 when o_custkey % 3 = 1 then 1 else 3 end as kind from orders where o_orderstatus <> 'F'),
rev as (select o_orderkey from orders where o_orderpriority = '5-LOW'),
i2 as (select * from inc where transaction_id not in (select * from rev))
select transaction_id, amount, receipt, case kind when 2 then true when 1 then false end as is_repayment, is_reversed = 1 as is_reversed from i2
union all select transaction_id, amount, null, null, is_reversed from cur where transaction_id not in (select * from rev) and transaction_id not in (select transaction_id from i2)""")
def load_transactions(spark, d):
    o = table(spark, d, "orders")
    kind = F.col("o_custkey") % 3
    incoming = o.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("transaction_id"), (F.col("o_totalprice") + 1).alias("amount"), (F.col("o_custkey") % 2).alias("is_reversed"),
        F.when(F.col("o_custkey") % 5 == 0, "  ").otherwise(F.col("o_orderpriority")).alias("receipt"),
        F.when(kind == 0, 2).when(kind == 1, 1).otherwise(3).alias("transaction_type"))
    target = o.filter("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_totalprice").alias("amount"), F.lit(None).cast("string").alias("receipt"),
        F.lit(None).cast("boolean").alias("is_repayment"), F.lit(False).alias("is_reversed"))
    gone = o.filter("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("transaction_id"))
    return extract.load_transactions(target, incoming, gone, ["receipt"], ["transaction_id"], ["amount"])


@query("scd2_products", _PRODUCT_SQL + """
, pair as (select l.p_partkey as k, i.p_partkey as ik, l.*, i.p_name is distinct from l.p_name or i.p_retailprice <> l.p_retailprice as changed from live l left join incoming i using (p_partkey))
select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, timestamp '1999-01-01' as valid_from,
  case when ik is not null and changed then timestamp '2001-08-01' end as valid_to, not (ik is not null and changed) as is_current from (
  select l.*, i.p_partkey as ik, (i.p_name is distinct from l.p_name or i.p_retailprice <> l.p_retailprice) as changed from live l left join incoming i on i.p_partkey = l.p_partkey)
union all select i.p_partkey, i.p_name, i.p_brand, i.p_type, i.p_size, i.p_retailprice, timestamp '2001-08-01', null, true from incoming i left join live l on i.p_partkey = l.p_partkey
  where l.p_partkey is null or i.p_name is distinct from l.p_name or i.p_retailprice <> l.p_retailprice
union all select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice - 1, timestamp '1998-01-01', timestamp '1999-01-01', false from part""")
def scd2_products(spark, d):
    return merge.scd2_merge(_product_versions(spark, d), _product_changes(spark, d), ["p_partkey"], TRACKED, CUT)


def _keyed_versions(spark, d):
    """Stored versions with a key each, which facts point at."""
    rows = _product_versions(spark, d)
    return rows.withColumn("product_key", F.col("p_partkey") * 10 + F.year("valid_from") % 10)


@query("loan_fact_repointed", """
with first_cut as (select p_partkey, case when p_partkey % 11 = 0 then null else p_name end as p_name, case when p_partkey % 7 = 0 then p_retailprice + 1 else p_retailprice end as price
    from part where p_partkey % 10 <> 3),
fact as (select loan_id, loan_id % 200 as product, loan_id % 3 = 0 as points_at_history from loans),
own as (
  select f.loan_id, p.p_partkey, p.p_name, p.p_retailprice, f.points_at_history, c.p_partkey is not null as delivered, c.p_name as name_1, c.price as price_1,
    c.p_partkey is not null and (c.p_name is distinct from p.p_name or c.price <> p.p_retailprice) as changed_1,
    c.p_partkey is not null and p.p_partkey % 14 < 2 as changed_2
  from fact f join part p on p.p_partkey = f.product left join first_cut c on c.p_partkey = p.p_partkey
  where f.points_at_history or p.p_partkey % 10 <> 5)
select loan_id, p_partkey,
  case when points_at_history then timestamp '1998-01-01' when changed_2 then timestamp '2001-09-01' when changed_1 then timestamp '2001-08-01' else timestamp '1999-01-01' end as valid_from,
  case when points_at_history then p_retailprice - 1 when changed_2 then price_1 + 5 when changed_1 then price_1 else p_retailprice end as p_retailprice,
  case when points_at_history then p_name when changed_2 or changed_1 then name_1 else p_name end as p_name
from own""", ("loans",))
def loan_fact_repointed(spark, d):
    """Two product deliveries, one after the other; facts of replaced versions follow to the newest, facts of older history stay."""
    later = dt.datetime(2001, 9, 1)
    first = merge.scd2_merge(_keyed_versions(spark, d), _product_changes(spark, d), ["p_partkey"], TRACKED, CUT, surrogate="product_key", tenant="lender")
    changes = _product_changes(spark, d)
    changes = changes.withColumn("p_retailprice", F.when(F.col("p_partkey") % 14 < 2, F.col("p_retailprice") + 5).otherwise(F.col("p_retailprice")))
    versions = merge.scd2_merge(first, changes, ["p_partkey"], TRACKED, later, surrogate="product_key", tenant="lender")
    facts = loans(spark, d).select("loan_id", ((F.col("loan_id") % 200) * 10 + F.when(F.col("loan_id") % 3 == 0, 8).otherwise(9)).alias("product_key"))
    moved = merge.repoint(facts, versions, ["p_partkey"], "product_key", "product_key", CUT)
    return moved.join(versions, "product_key").select("loan_id", "p_partkey", "valid_from", "p_retailprice", "p_name")


@query("upsert_products", _PRODUCT_SQL + """
select * from live where p_partkey not in (select p_partkey from incoming) union all select * from incoming""")
def upsert_products(spark, d):
    current = _products(spark, d).filter(F.col("p_partkey") % 10 != 5)
    return merge.upsert(current, _product_changes(spark, d), ["p_partkey"], ["p_retailprice"])


@query("upsert_newest", """
with inc as (select loan_id, line, max({'paid_on': paid_on, 'staff_id': staff_id, 'part_id': part_id}) as r from repayments where flag = 'R' group by 1, 2),
cur as (select loan_id, line, max({'paid_on': paid_on, 'staff_id': staff_id, 'part_id': part_id}) as r from repayments where flag <> 'R' group by 1, 2),
u as (select * from cur where (loan_id, line) not in (select (loan_id, line) from inc) union all select * from inc)
select loan_id, line, r.paid_on, r.staff_id, r.part_id from u""", ("repayments",))
def upsert_newest(spark, d):
    """Incoming rows repeat keys: the newest row per key wins."""
    from ledgerloom.operators.dedupe import pick_per_key
    rows = repayments(spark, d).select("loan_id", "line", "paid_on", "staff_id", "part_id", "flag")
    order = ["paid_on", "staff_id", "part_id"]
    current = pick_per_key(rows.filter("flag <> 'R'").drop("flag"), ["loan_id", "line"], order)
    return merge.upsert(current, rows.filter("flag = 'R'").drop("flag"), ["loan_id", "line"], order)


@query("overwrite_but_listed", """
select loan_id, client_id from loans where loan_id in (1, 2, 3) union all select loan_id + 1000000000, client_id from loans where loan_status = 600""", ("loans",))
def overwrite_but_listed(spark, d):
    rows = loans(spark, d).select("loan_id", "client_id", "loan_status")
    fresh = rows.filter("loan_status = 600").select((F.col("loan_id") + 1000000000).alias("loan_id"), "client_id")
    return merge.replace_except(rows.drop("loan_status"), fresh, "loan_id", [1, 2, 3])


@query("frame_diff", _PRODUCT_SQL + """
select i.* from incoming i left join live l on i.p_partkey = l.p_partkey where l.p_partkey is null or i.p_name is distinct from l.p_name or i.p_retailprice <> l.p_retailprice""")
def frame_diff(spark, d):
    return merge.frame_diff(_product_changes(spark, d), _products(spark, d).filter(F.col("p_partkey") % 10 != 5), ["p_partkey", *TRACKED])


@query("sync_by_key", _PRODUCT_SQL + """
select i.*, case when l.p_partkey is null then 'insert' else 'update' end as action from incoming i left join live l on i.p_partkey = l.p_partkey
where l.p_partkey is null or i.p_name is distinct from l.p_name or i.p_retailprice <> l.p_retailprice""")
def sync_by_key(spark, d):
    return merge.sync(_products(spark, d).filter(F.col("p_partkey") % 10 != 5), _product_changes(spark, d), "p_partkey", ["p_partkey", *TRACKED])


@query("audit_changes", _PRODUCT_SQL + """
select i.p_partkey, 'p_name' as column_name, l.p_name as previous_value, i.p_name as current_value, timestamp '2001-08-01 03:00:00' as updated_at, 'cleaning' as source
from incoming i join live l on i.p_partkey = l.p_partkey where i.p_name is distinct from l.p_name""")
def audit_changes(spark, d):
    out = merge.audit_changes(_products(spark, d).filter(F.col("p_partkey") % 10 != 5), _product_changes(spark, d), "p_partkey",
                              ["p_name", "p_brand", "p_type"], "cleaning", CUT)
    return out.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz"))


@query("fill_missing", """
select o_orderkey as loan_id, case when o_orderstatus = 'P' then c_name else o_orderpriority end as label, case when o_custkey % 2 = 0 then 'x' else c_mktsegment end as segment
from orders left join customer on c_custkey = o_custkey""")
def fill_missing(spark, d):
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("client_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("label"),
        F.when(F.col("o_custkey") % 2 == 0, "x").alias("segment"))
    source = clients(spark, d).select("client_id", F.col("client_name").alias("label"), "segment")
    return merge.fill_missing(o, source, "client_id", ["label", "segment"]).select("loan_id", "label", "segment")


@query("drop_fact_duplicates", """
select loan_id, line, part_id, staff_id, paid_on from (select *, rank() over (partition by loan_id, line order by paid_on) as r from repayments) where r = 1""", ("repayments",))
def drop_fact_duplicates(spark, d):
    """The oldest version of a fact stays; versions of the same age all stay."""
    return latest_per_key(repayments(spark, d), ["loan_id", "line"], F.col("paid_on").asc()).select("loan_id", "line", "part_id", "staff_id", "paid_on")


@query("key_resolution", """
select loan_id, 'C' || l.client_id as client_key, 'P' || (loan_id % 2000) as product_key, case when loan_status <> 700 then 'S' || loan_status end as status_key,
  s.s_name as officer_key, case when loan_id % 2 = 0 then 'individual' else 'group' end as loan_type, r.r_name as transaction_strategy, 'every ' || (loan_id % 3) as term_frequency,
  l.client_id % 3 <> 0 as is_npa, l.client_id % 2 <> 0 as accounting_recognised, case when l.client_id % 5 > 0 then l.client_id % 4 <> 0 end as sync_with_meeting, false as variable_instalments
from loans l join clients c on c.client_id = l.client_id and c.segment <> 'BUILDING' join part p on p.p_partkey = loan_id % 2000
left join supplier s on s.s_suppkey = loan_id % 150 left join region r on r.r_regionkey = loan_id % 7""", ("loans", "clients"))
def key_resolution(spark, d):
    """Surrogate keys, the three looked-up codes (some without a text) and the four flags (0, 1, other numbers and none)."""
    key, client = F.col("loan_id"), F.col("client_id")
    src = loans(spark, d).withColumns({
        "product_id": key % 2000, "officer_id": key % 150, "loan_type_id": key % 2, "transaction_strategy_id": key % 7, "term_frequency_id": key % 3,
        "is_npa": client % 3, "accounting_recognised": client % 2, "sync_with_meeting": F.when(client % 5 > 0, client % 4), "variable_instalments": F.lit(0)})
    c = clients(spark, d).filter("segment <> 'BUILDING'").select(F.col("client_id").alias("core_id"), F.concat(F.lit("C"), F.col("client_id").cast("string")).alias("surrogate_id"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("core_id"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("surrogate_id"))
    s = loans(spark, d).filter("loan_status <> 700").select(F.col("loan_status").alias("core_id")).distinct().withColumn("surrogate_id", F.concat(F.lit("S"), F.col("core_id").cast("string")))
    o = table(spark, d, "supplier").select(F.col("s_suppkey").alias("core_id"), F.col("s_name").alias("surrogate_id"))
    e = table(spark, d, "region").filter("r_regionkey < 2").select(F.lit("loan_type").alias("enum_name"), F.col("r_regionkey").alias("enum_id"),
                                                                  F.when(F.col("r_regionkey") == 0, "individual").otherwise("group").alias("enum_value"))
    e = e.unionByName(table(spark, d, "region").select(F.lit("transaction_strategy").alias("enum_name"), F.col("r_regionkey").alias("enum_id"), F.col("r_name").alias("enum_value"))).unionByName(
        table(spark, d, "region").filter("r_regionkey < 3").select(F.lit("term_frequency").alias("enum_name"), F.col("r_regionkey").alias("enum_id"),
                                                                  F.concat(F.lit("every "), F.col("r_regionkey").cast("string")).alias("enum_value")))
    return extract.resolve_keys(src, c, p, s, o, e).select("loan_id", "client_key", "product_key", "status_key", "officer_key", *extract.ENUMS, *extract.FLAGS)


@query("loan_fact", """
with src as (select loan_id, 'C' || client_id as client_key, case when loan_id % 5 = 0 then loan_status + 1 else loan_status end as loan_status, disbursed_on from loans where loan_id % 4 <> 1),
ver as (select cast(date_trunc('year', disbursed_on) as date) as end_date, 'v' || year(disbursed_on) as model_version from loans group by all),
found as (select s.*, v.model_version from src s asof left join ver v on s.disbursed_on > v.end_date),
cur as (select loan_id, 'C' || client_id as client_key, loan_status, case when loan_id % 2 = 0 then 'kept' end as model_version from loans where loan_id % 4 <> 2),
ready as (select a.loan_id, a.client_key, a.loan_status, coalesce(c.model_version, a.model_version) as model_version from found a left join cur c using (loan_id))
select c.loan_id, c.client_key, c.loan_status, case when coalesce(r.loan_status <> c.loan_status, false) then c.model_version else coalesce(c.model_version, r.model_version) end as model_version,
  timestamp '1999-01-01' as valid_from, case when r.loan_status <> c.loan_status then timestamp '2001-08-01' end as valid_to,
  not coalesce(r.loan_status <> c.loan_status, false) as is_current
from cur c left join ready r using (loan_id)
union all select r.loan_id, r.client_key, r.loan_status, r.model_version, timestamp '2001-08-01', null, true from ready r left join cur c using (loan_id)
where c.loan_id is null or r.loan_status <> c.loan_status""", ("loans",))
def loan_fact(spark, d):
    """The whole fact build: keys, model version, versions, one current row."""
    base = loans(spark, d)
    src = base.filter("loan_id % 4 <> 1").withColumn("loan_status", F.when(F.col("loan_id") % 5 == 0, F.col("loan_status") + 1).otherwise(F.col("loan_status"))).withColumns({
        "product_id": F.col("loan_id") % 25, "officer_id": F.col("loan_id") % 7, "loan_type_id": F.col("loan_id") % 5})
    products = table(spark, d, "nation").select(F.col("n_nationkey").alias("core_id"), F.col("n_name").alias("surrogate_id"))
    officers = table(spark, d, "region").select(F.col("r_regionkey").alias("core_id"), F.col("r_name").alias("surrogate_id"))
    dims = {
        "clients": clients(spark, d).select(F.col("client_id").alias("core_id"), F.concat(F.lit("C"), F.col("client_id").cast("string")).alias("surrogate_id")),
        "products": products, "officers": officers,
        "statuses": base.select(F.col("loan_status").alias("core_id")).distinct().withColumn("surrogate_id", F.lit("S"))}
    enums = table(spark, d, "region").select(F.lit("loan_type").alias("enum_name"), F.col("r_regionkey").alias("enum_id"), F.col("r_name").alias("enum_value"))
    versions = base.groupBy(F.trunc("disbursed_on", "YEAR").alias("end_date")).agg(F.max(F.year("disbursed_on")).alias("year"))
    versions = versions.select("end_date", F.concat(F.lit("v"), F.col("year").cast("string")).alias("model_version"))
    current = base.filter("loan_id % 4 <> 2").select(
        "loan_id", F.concat(F.lit("C"), F.col("client_id").cast("string")).alias("client_key"), "loan_status",
        F.when(F.col("loan_id") % 2 == 0, "kept").alias("model_version"), F.lit(dt.datetime(1999, 1, 1)).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    return plans.build_loan_fact(src, dims, enums, versions, current, ["client_key", "loan_status"], CUT)


@query("loan_summary", """
select loan_id, disbursed_on, client_name, n_name as office, cast(year(disbursed_on) as bigint) as partition_year, cast(month(disbursed_on) as bigint) as partition_month
from loans join clients using (client_id) join nation on n_nationkey = office_id where loan_status = 300""", ("loans", "clients"))
def loan_summary(spark, d):
    fact = loans(spark, d).filter("loan_status = 300").select("loan_id", "disbursed_on", F.col("client_id").alias("client_key"), (F.col("loan_id") % 5).alias("status_key"), F.lit(True).alias("is_current"))
    c = clients(spark, d).select(F.col("client_id").alias("client_key"), "client_name", F.col("office_id").alias("product_key"))
    p = table(spark, d, "nation").select(F.col("n_nationkey").alias("product_key"), F.col("n_name").alias("office"))
    s = table(spark, d, "region").select(F.col("r_regionkey").alias("status_key"), F.col("r_name").alias("status"))
    out = plans.with_month(plans.loan_summary(fact, c, p, s), "disbursed_on")
    return out.select("loan_id", "disbursed_on", "client_name", "office", F.col("partition_year").cast("long").alias("partition_year"),
                      F.col("partition_month").cast("long").alias("partition_month"))


@query("column_mapping", "select cast(c_custkey as varchar) as id, c_name as name, cast(null as varchar) as email from customer")
def column_mapping(spark, d):
    raw = table(spark, d, "customer").toDF(" C_CUSTKEY ", "C_NAME", "C_NATIONKEY", "C_ACCTBAL", " c_mktsegment")
    out = extract.map_columns(extract.clean_names(raw), {"id": "c_custkey", "name": "c_name", "email": "c_email"})
    return out.withColumn("id", F.col("id").cast("string"))


@query("known_partners", "select distinct o_orderkey, cast(o_custkey as varchar) as partner from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)")
def known_partners(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("partner"))
    known = table(spark, d, "customer").filter("c_acctbal > 0").select(F.concat(F.col("c_custkey").cast("string"), F.lit("  ")).alias("partner"))
    return merge.keep_known(o, known, "partner", trimmed=True).distinct().withColumn("partner", F.trim("partner"))


@query("collections_notes", """
select distinct r.loan_id as case_id, r.line, r.staff_id from repayments r where r.staff_id in (select s_suppkey from supplier where s_acctbal > 2000)
  and r.loan_id in (select loan_id from loans where loan_status = 300) and r.loan_id not in (select loan_id from repayments where line = 7)""", ("loans", "repayments"))
def collections_notes(spark, d):
    notes = repayments(spark, d).select(F.col("loan_id").alias("case_id"), "line", "staff_id")
    stored = notes.filter("line = 7")
    return extract.collections_entity(notes, stored, "case_id", [
        (table(spark, d, "supplier").filter("s_acctbal > 2000"), "staff_id", "s_suppkey"),
        (loans(spark, d).filter("loan_status = 300"), "case_id", "loan_id")])


def _stalls(spark, d):
    item = lambda i: F.struct(F.concat_ws("/", "o_orderkey", F.lit(i)).alias("stall_id"), (F.col("o_custkey") + i).alias("size"))
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("customer_id"), F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(F.to_json(F.array(item(1), item(2)))).alias("stalls"))


@query("json_explode", """
select o_orderkey as customer_id, o_orderkey || '/' || i as stall_id, o_custkey + i as size from orders, (values (1), (2)) v(i) where o_orderkey % 3 <> 0 and not (i = 2 and o_orderkey % 5 = 0)""")
def json_explode(spark, d):
    known = table(spark, d, "orders").filter("o_orderkey % 5 = 0").select(F.concat_ws("/", "o_orderkey", F.lit(2)).alias("id"))
    return extract.new_children(_stalls(spark, d), "customer_id", "stalls", "stall_id: string, size: bigint", ["stall_id", "size"], known, "id").select(
        "customer_id", "stall_id", "size")


@query("delivery_offers", """
select o_orderkey as delivery_id, case when o_custkey % 4 = 0 then 'Duplicate' when o_custkey % 4 = 1 then 'Any other reason' when o_custkey % 4 = 2 then 'Requested more than limit' else 'new code' end as rejection_reason,
  case when o_orderstatus = 'F' then cast(o_orderkey as varchar) end as loan_id, o_orderpriority as offer_response from orders
where o_orderdate < timestamp '2000-01-01' and o_orderkey not in (select l_orderkey from lineitem where l_linenumber = 1) and o_custkey in (select c_custkey from customer where c_acctbal > 0)""")
def delivery_offers(spark, d):
    kind = F.col("o_custkey") % 4
    offers = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("delivery_id"), F.col("o_custkey").alias("stall_id"), F.col("o_orderdate").alias("offer_expiry"),
        F.when(kind == 0, "1001").when(kind == 1, "1002").when(kind == 2, "1003").otherwise("new code").alias("rejection_reason"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).when(F.col("o_orderstatus") == "O", " NOT POSTED").otherwise("REJECTED ").alias("loan_id"),
        F.to_json(F.struct(F.col("o_orderpriority").alias("status_code"))).alias("offer_response"))
    known = repayments(spark, d).filter("line = 1").select(F.col("loan_id").alias("delivery_id"))
    stalls = clients(spark, d).filter("balance > 0").select(F.col("client_id").alias("stall_id"))
    out = extract.deliveries(offers, known, stalls, dt.datetime(2000, 1, 1))
    return out.select("delivery_id", "rejection_reason", "loan_id", "offer_response")


@query("suspension_changes", """
with ev as (select distinct client_id as shop, loan_status = 300 as is_suspended, case when loan_status = 300 then disbursed_on end as start_date, case when loan_status <> 300 then disbursed_on end as end_date from loans),
cur as (select client_id as shop, client_id % 2 = 0 as is_suspended, date '1998-06-01' as d from clients where segment = 'BUILDING')
select ev.* from ev left join cur on ev.shop = cur.shop and ev.is_suspended = cur.is_suspended
where cur.shop is null or not (cur.d <= coalesce(ev.start_date, ev.end_date))""", ("loans", "clients"))
def suspension_changes(spark, d):
    held = F.col("loan_status") == 300
    events = loans(spark, d).select(F.col("client_id").alias("shop"), held.alias("is_suspended"), F.when(held, F.col("disbursed_on")).alias("start_date"),
                                    F.when(~held, F.col("disbursed_on")).alias("end_date"))
    day, even = F.lit("1998-06-01").cast("date"), F.col("client_id") % 2 == 0
    current = clients(spark, d).filter("segment = 'BUILDING'").select(
        F.col("client_id").alias("shop"), even.alias("is_suspended"), F.when(even, day).alias("start_date"), F.when(~even, day).alias("end_date"))
    return extract.suspension_changes(events, current)


@query("suspension_expiry", """
with ev as (select client_id as shop, disbursed_on as day from loans),
cur as (select client_id as shop, client_id % 2 = 0 as is_suspended, date '1998-06-01' as d from clients where segment = 'BUILDING')
select shop, is_suspended, (select min(day) from ev where ev.shop = cur.shop and day > cur.d) as expired_on from cur""", ("loans", "clients"))
def suspension_expiry(spark, d):
    held = F.col("loan_status") == 300
    events = loans(spark, d).select(F.col("client_id").alias("shop"), held.alias("is_suspended"), F.when(held, F.col("disbursed_on")).alias("start_date"),
                                    F.when(~held, F.col("disbursed_on")).alias("end_date"))
    day, even = F.lit("1998-06-01").cast("date"), F.col("client_id") % 2 == 0
    current = clients(spark, d).filter("segment = 'BUILDING'").select(
        F.col("client_id").alias("shop"), even.alias("is_suspended"), F.when(even, day).alias("start_date"), F.when(~even, day).alias("end_date"))
    return extract.expire_suspensions(current, events).select("shop", "is_suspended", "expired_on")


@query("officer_history", """
select l_orderkey * 10 + l_linenumber as core_id, l_orderkey as loan_id, l_suppkey as officer_id, cast(l_shipdate as date) as assigned_on,
  case when l_linestatus = 'F' then cast(l_shipdate as date) + 30 end as released_on from lineitem where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')""")
def officer_history(spark, d):
    day = F.to_date("l_shipdate")
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("loan_id"), F.col("l_suppkey").alias("loan_officer_id"),
                                              day.alias("start_date"), F.when(F.col("l_linestatus") == "F", F.date_add(day, 30)).alias("end_date"))
    stored = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.col("o_orderkey") * 10 + i)).alias("core_id"))
    return extract.officer_history(rows, stored)


@query("company_list", """
select distinct p_brand as company, true as is_multinational, false as is_federal_government from part where p_brand not in (select p_brand from part where p_size = 1)""")
def company_list(spark, d):
    names = table(spark, d, "part").select(F.concat(F.col("p_brand"), F.lit("  ")).alias("company"))
    known = table(spark, d, "part").filter("p_size = 1").select(F.col("p_brand").alias("company"))
    return extract.company_lists(names, known, "company", {"is_multinational": True, "is_federal_government": False})


@query("correct_fact_keys", """
select l.loan_id, l.client_id, l.loan_id % 9 = 0 as corrected from loans l""", ("loans",))
def correct_fact_keys(spark, d):
    core = loans(spark, d).select("loan_id", "client_id")
    facts = core.withColumn("client_id", F.when(F.col("loan_id") % 9 == 0, F.col("client_id") + 1).otherwise(F.col("client_id")))
    return extract.correct_keys(facts, core, "loan_id", "client_id").select("loan_id", "client_id", "corrected")


@query("long_id_replacement", """
with opt as (select client_id as store_number, max({'d': disbursed_on, 'n': 'N' || loan_id}).n as short from loans where loan_status = 300 group by 1),
c as (select client_id as store_number, case when client_id % 2 = 0 then lpad(cast(client_id as varchar), 18, '9') else cast(client_id as varchar) end as nid from clients)
select store_number, case when length(nid) > 15 then coalesce(short, nid) else nid end as national_id from c left join opt using (store_number)""", ("loans", "clients"))
def long_id_replacement(spark, d):
    key = F.col("client_id").cast("string")
    c = clients(spark, d).select(F.col("client_id").alias("store_number"), F.when(F.col("client_id") % 2 == 0, F.lpad(key, 18, "9")).otherwise(key).alias("national_id"))
    opt = loans(spark, d).filter("loan_status = 300").select(F.col("client_id").alias("store_number"), F.col("disbursed_on").alias("opt_in_date"),
                                                             F.concat(F.lit("N"), F.col("loan_id").cast("string")).alias("national_id"))
    return extract.long_id_replacements(c, opt)


@query("whitelist_details", """
with who as (select client_id as store_number, client_name from clients),
why as (select client_id as store_number, channel as reason, loan_id from (select *, rank() over (partition by client_id order by 'v' || loan_id desc) as r from loans) where r = 1)
select s.part_id as store_number, who.client_name, case when c.segment = 'MACHINERY' then true end as is_suspended, why.reason
from (select distinct part_id from repayments) s left join who on who.store_number = s.part_id left join clients c on c.client_id = s.part_id left join why on why.store_number = s.part_id""",
       ("loans", "clients", "repayments"))
def whitelist_details(spark, d):
    listed = repayments(spark, d).select(F.col("part_id").alias("store_number")).distinct()
    who = clients(spark, d).select(F.col("client_id").alias("store_number"), "client_name", F.lit("2").alias("version"))
    older = who.withColumns({"version": F.lit("1"), "client_name": F.lit("old name")})
    held = clients(spark, d).filter("segment = 'MACHINERY'").select(F.col("client_id").alias("store_number"), F.lit(True).alias("is_suspended"), F.lit(True).alias("is_current"))
    why = loans(spark, d).select(F.col("client_id").alias("store_number"), F.col("channel").alias("reason"), F.concat(F.lit("v"), F.col("loan_id").cast("string")).alias("model_version"))
    return extract.whitelist_details(listed, who.unionByName(older), held, why).select("store_number", "client_name", "is_suspended", "reason")


@query("bulk_rename", "select loan_id as core_id, client_id as client_core_id, channel as product_name from loans", ("loans",))
def bulk_rename(spark, d):
    return loans(spark, d).select("loan_id", "client_id", "channel").withColumnsRenamed({"loan_id": "core_id", "client_id": "client_core_id", "channel": "product_name"})


@query("corrections", """
select client_id, case when client_id % 4 = 0 then 'fixed ' || client_name else client_name end as client_name, segment from clients""", ("clients",))
def corrections(spark, d):
    target = clients(spark, d).select("client_id", "client_name", "segment")
    fixes = target.filter("client_id % 4 = 0").select("client_id", F.concat(F.lit("fixed "), F.col("client_name")).alias("client_name"), F.lit(None).cast("string").alias("segment"))
    return merge.apply_corrections(target, fixes, "client_id", ["client_name", "segment"], "operations", CUT)[0]


@query("corrections_log", """
select client_id, 'client_name' as column_name, client_name as previous_value, 'fixed ' || client_name as current_value, 'operations' as source from clients where client_id % 4 = 0""", ("clients",))
def corrections_log(spark, d):
    target = clients(spark, d).select("client_id", "client_name", "segment")
    fixes = target.filter("client_id % 4 = 0").select("client_id", F.concat(F.lit("fixed "), F.col("client_name")).alias("client_name"), F.lit(None).cast("string").alias("segment"))
    return merge.apply_corrections(target, fixes, "client_id", ["client_name", "segment"], "operations", CUT)[1].drop("updated_at")


@query("till_activity_day", """
select event_id, ts as transaction_time, value * 1000 as balance from events where ts >= timestamp '2024-01-12' and ts < timestamp '2024-01-13'""")
def till_activity_day(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("ts").alias("transaction_time"), F.format_number(F.col("value") * 1000, 2).alias("balance"))
    return ingest.till_activity(rows, "2024-01-12", "2024-02-10")


@query("survey_text", "select conv_id, turn, trim(regexp_replace(text, '[\r\n\"'']+', ' ', 'g'), ' ') as text from conversations")
def survey_text(spark, d):
    return ingest.survey_answers(table(spark, d, "conversations").select("conv_id", "turn", "text"), ["text"])
