"""Lists that are delivered as files, lookup sheets, and the entities of the collections system."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import clients, loans, query, table
from ledgerloom.operators import extract, ingest
from ledgerloom.session import shared_dir
from ledgerloom.sources import readers, sinks

_DEFAULTERS = "customer_name string, balance double, loan_status string"


@query("defaulter_list", """
select c_name as customer_name, c_acctbal as balance, 'late' as loan_status, date '2024-01-12' as file_date from customer where c_custkey % 2 = 0
union all select c_name, c_acctbal, 'older list', date '2024-01-01' from customer where c_custkey % 5 = 0""")
def defaulter_list(spark, d):
    """Deliveries of three days: the newest takes the place of the newest stored list; lists of days before stay."""
    path = shared_dir(spark, "defaulters")
    rows = table(spark, d, "customer").select(F.col("c_name").alias("customer_name"), F.col("c_acctbal").alias("balance"), "c_custkey")
    for day, share in (("2024-01-09", 7), ("2024-01-12", 2), ("2024-01-10", 3)):
        sinks.export_csv(rows.filter(F.col("c_custkey") % share == 0).select("customer_name", "balance", F.lit("late").alias("loan_status")), f"{path}/{day}")
    stored = rows.select("customer_name", "balance", F.lit("stored").alias("loan_status"), F.lit(dt.date(2024, 1, 10)).alias("file_date")).unionByName(
        rows.filter("c_custkey % 5 = 0").select("customer_name", "balance", F.lit("older list").alias("loan_status"), F.lit(dt.date(2024, 1, 1)).alias("file_date")))
    return ingest.replace_when_newer(spark, path, _DEFAULTERS, "part-*", stored)


@query("location_mapping", """
with new as (select s_suppkey as short_code, s_suppkey % 50 as till_number, max({'lat': s_acctbal, 'name': s_name}) as r from supplier where s_suppkey % 3 > 0 group by 1, 2),
old as (select s_suppkey as short_code, s_suppkey % 50 as till_number from supplier where s_suppkey % 2 = 0)
select short_code, till_number, r.lat as latitude, r.name as business_name from new
union all select short_code, till_number, 0.0, 'unknown' from old where short_code not in (select short_code from new)""")
def location_mapping(spark, d):
    """Places of shops, merged by short code and till from a sheet with its header in the first line; the sheet repeats rows."""
    shops = table(spark, d, "supplier")
    path = shared_dir(spark, "locations")
    sheet = shops.filter("s_suppkey % 3 > 0").select(F.col("s_suppkey").alias("SHORT_CODE"), (F.col("s_suppkey") % 50).alias("TILL_NUMBER"), F.col("s_acctbal").alias("Latitude"),
                                                     F.col("s_name").alias("Business Name"))
    sinks.export_csv(sheet.unionByName(sheet.filter("SHORT_CODE % 5 = 0")).coalesce(1), path)
    rows = readers.sheet(spark, path, {"SHORT_CODE": "short_code", "TILL_NUMBER": "till_number", "Latitude": "latitude", "Business Name": "business_name"}, 0)
    delivered = rows.withColumns({"short_code": F.col("short_code").cast("long"), "till_number": F.col("till_number").cast("long"), "latitude": F.col("latitude").cast("double")})
    current = shops.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("short_code"), (F.col("s_suppkey") % 50).alias("till_number"), F.lit(0.0).alias("latitude"),
                                                      F.lit("unknown").alias("business_name"))
    return ingest.location_mapping(current, delivered)


@query("lookup_sheets", """
select 'ledgers' as list, n_nationkey::varchar as code, 'Account, "' || n_name || '"' as description, case when n_nationkey % 4 > 0 then 'T' || n_regionkey end as kind from nation
union all select 'complaints', r_regionkey::varchar, r_name, null from region""")
def lookup_sheets(spark, d):
    """Two sheets of one workbook, saved as CSV: titles above, the header in the third line, columns in any order."""
    path = shared_dir(spark, "sheets")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    kind = F.when(F.col("n_nationkey") % 4 > 0, F.concat(F.lit("T"), F.col("n_regionkey").cast("string"))).otherwise("  ")
    rows = {
        "ledgers": ("Workbook,,\nGL codes,,\nGL TYPE, GL CODE ,GL DESCRIPTION\n",
                    nation.select(F.concat_ws(",", kind, F.col("n_nationkey").cast("string"), quoted(F.concat(F.lit('Account, "'), F.col("n_name"), F.lit('"')))).alias("line"))),
        "complaints": ("Workbook\nComplaints\nClassification,Code\n", region.select(F.concat_ws(",", "r_name", F.col("r_regionkey").cast("string")).alias("line")))}
    for name, (head, lines) in rows.items():
        lines.agg(F.array_sort(F.collect_list("line")).alias("lines")).select(F.concat(F.lit(head), F.array_join("lines", "\n")).alias("value")).coalesce(1).write.text(f"{path}/{name}")
    ledgers = readers.sheet(spark, f"{path}/ledgers", {"GL CODE": "code", "GL DESCRIPTION": "description", "GL TYPE": "kind"}, 2)
    complaints = readers.sheet(spark, f"{path}/complaints", {"Code": "code", "Classification": "description"}, 2)
    return ledgers.select(F.lit("ledgers").alias("list"), "*").unionByName(complaints.select(F.lit("complaints").alias("list"), "*"), allowMissingColumns=True)


@query("collections_cases", """
select loan_id + 7 as core_id, loan_id, case when loan_id % 2 = 0 then 'retail' else 'wholesale' end as tenant from loans where loan_id + 7 not in (select loan_id from loans where loan_status = 700)""", ("loans",))
def collections_cases(spark, d):
    rows = loans(spark, d)
    cases = rows.select((F.col("loan_id") + 7).alias("core_id"), "loan_id", F.when(F.col("loan_id") % 2 == 0, "retail").otherwise("wholesale").alias("tenant"))
    return extract.collections_entity(cases, rows.filter("loan_status = 700").select(F.col("loan_id").alias("core_id")), "core_id", [])


@query("collections_users", """
select s_suppkey as core_id, s_name as names, 'u' || s_suppkey || '@mail' as email from supplier where s_suppkey not in (select s_suppkey from supplier where s_acctbal < 0)""")
def collections_users(spark, d):
    staff = table(spark, d, "supplier")
    users = staff.select(F.col("s_suppkey").alias("core_id"), F.col("s_name").alias("names"), F.concat(F.lit("u"), F.col("s_suppkey").cast("string"), F.lit("@mail")).alias("email"))
    return extract.collections_entity(users, staff.filter("s_acctbal < 0").select(F.col("s_suppkey").alias("core_id")), "core_id", [])


@query("collections_statuses", """
select n_nationkey as core_id, n_name as title, 'about ' || n_name as description, r_name as contact_type from nation left join region on r_regionkey = n_nationkey % 8 where n_nationkey % 6 <> 1""")
def collections_statuses(spark, d):
    nation = table(spark, d, "nation")
    statuses = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("title"), F.concat(F.lit("about "), "n_name").alias("description"), (F.col("n_nationkey") % 8).alias("contact_type_id"))
    types = table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("title"))
    return extract.contact_statuses(statuses, types, nation.filter("n_nationkey % 6 = 1").select(F.col("n_nationkey").alias("core_id")))


@query("collections_promises", """
select l_orderkey * 10 + l_linenumber as core_id, l_orderkey as case_id, l_extendedprice as amount, cast(l_shipdate as date) as promised_on, case when l_linestatus = 'F' then l_extendedprice end as paid
from (select distinct * from lineitem) where l_linenumber <> 7 and l_orderkey in (select o_orderkey from orders where o_orderstatus <> 'O')
group by all""")
def collections_promises(spark, d):
    r = table(spark, d, "lineitem")
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    promises = r.select(number.alias("core_id"), F.col("l_orderkey").alias("case_id"), F.col("l_extendedprice").alias("amount"), F.to_date("l_shipdate").alias("promised_on"),
                        F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("paid"))
    known = r.filter("l_linenumber = 7").select(number.alias("core_id"))
    return extract.collections_entity(promises, known, "core_id", [(table(spark, d, "orders").filter("o_orderstatus <> 'O'"), "case_id", "o_orderkey")])


@query("collections_allocations", """
select distinct l_orderkey * 10 + l_linenumber as core_id, l_orderkey as case_id, l_suppkey as user_id, cast(l_shipdate as date) as date_from, cast(l_shipdate as date) + 30 as date_to
from lineitem where l_linenumber <> 6 and l_orderkey in (select o_orderkey from orders where o_orderstatus = 'O') and l_suppkey in (select s_suppkey from supplier where s_acctbal > 0)""")
def collections_allocations(spark, d):
    r, day = table(spark, d, "lineitem"), F.to_date("l_shipdate")
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = r.select(number.alias("core_id"), F.col("l_orderkey").alias("case_id"), F.col("l_suppkey").alias("user_id"), day.alias("date_from"), F.date_add(day, 30).alias("date_to"))
    return extract.collections_entity(rows, r.filter("l_linenumber = 6").select(number.alias("core_id")), "core_id", [
        (table(spark, d, "orders").filter("o_orderstatus = 'O'"), "case_id", "o_orderkey"), (table(spark, d, "supplier").filter("s_acctbal > 0"), "user_id", "s_suppkey")])


@query("clients_of_core_only", """
select client_id, segment, version from (select client_id, segment, case when client_id % 3 = 0 then null else (1 + client_id % 2)::varchar end as version from clients)
where version is distinct from '2' or client_id in (select client_id from loans where loan_status = 300)""", ("clients", "loans"))
def clients_of_core_only(spark, d):
    """Clients of one product version that the core system does not have are taken out of the warehouse."""
    held = clients(spark, d).select("client_id", "segment", F.when(F.col("client_id") % 3 == 0, F.lit(None)).otherwise((1 + F.col("client_id") % 2).cast("string")).alias("version"))
    return extract.drop_unknown(held, loans(spark, d).filter("loan_status = 300"), "client_id", "client_id", F.col("version") == "2")
