"""Normalisers and scalar functions over whole tables."""
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import AS_OF, query, table
from ledgerloom.functions import dates, numbers, payload, text


@query("normalise_ids", """
with raw as (select c_custkey, case c_custkey % 6 when 0 then '000000000' when 1 then c_custkey || '.0' when 2 then '  ' || c_custkey
    when 3 then 'nan' when 4 then ' ' else '00' || c_custkey || '_old' end as raw_id from customer),
clean as (select *, regexp_replace(trim(raw_id), '\\.0$', '') as short_id from raw)
select c_custkey, raw_id,
  case when trim(short_id) in ('000000000','0','nan','None','-1','null','nan--','') then null else short_id end as clean_id,
  trim(split_part(raw_id, '_', 1)) as before_mark, nullif(short_id, cast(c_custkey as varchar)) as other_id,
  regexp_replace(trim(raw_id), '^0+', '') as without_zeros,
  regexp_matches(short_id, '^[0-9.]+$') and length(short_id) <= 8 and not regexp_matches(short_id, '^0+$') as is_plain
from clean""")
def normalise_ids(spark, d):
    key = F.col("c_custkey").cast("string")
    kind = F.col("c_custkey") % 6
    raw = (F.when(kind == 0, "000000000").when(kind == 1, F.concat(key, F.lit(".0"))).when(kind == 2, F.concat(F.lit("  "), key))
           .when(kind == 3, "nan").when(kind == 4, " ").otherwise(F.concat(F.lit("00"), key, F.lit("_old"))))
    df = table(spark, d, "customer").select("c_custkey", raw.alias("raw_id"))
    short = text.strip_decimal_suffix(F.col("raw_id"))
    return df.select("c_custkey", "raw_id", text.null_tokens(short).alias("clean_id"),
                     text.before_underscore(F.col("raw_id")).alias("before_mark"),
                     text.null_if_equal(short, key).alias("other_id"),
                     text.strip_leading_zeros(F.col("raw_id")).alias("without_zeros"), text.is_plain_id(short).alias("is_plain"))


@query("phone_numbers", """
with raw as (select c_custkey, lpad(cast(c_custkey as varchar), 8, '1') as n from customer),
phones as (select c_custkey, case c_custkey % 6 when 0 then '07' || n when 1 then '+2547' || n when 2 then '2547' || n
    when 3 then 'tel' || n when 4 then '7' || n else '2541' || n || '9' end as raw_phone from raw),
std as (select *, case when regexp_matches(raw_phone, '[a-zA-Z]') then null when raw_phone like '0%' then '254' || substr(raw_phone, 2)
    when raw_phone like '+%' then substr(raw_phone, 2) else raw_phone end as phone from phones)
select c_custkey, raw_phone, phone, case when (phone like '254%' and length(phone) <> 12) or (phone like '0%' and length(phone) <> 10)
    or (phone like '7%' and length(phone) <> 9) or (phone like '1%' and length(phone) <> 9) then null else phone end as valid_phone
from std""")
def phone_numbers(spark, d):
    n, kind = F.lpad(F.col("c_custkey").cast("string"), 8, "1"), F.col("c_custkey") % 6
    raw = (F.when(kind == 0, F.concat(F.lit("07"), n)).when(kind == 1, F.concat(F.lit("+2547"), n))
           .when(kind == 2, F.concat(F.lit("2547"), n)).when(kind == 3, F.concat(F.lit("tel"), n))
           .when(kind == 4, F.concat(F.lit("7"), n)).otherwise(F.concat(F.lit("2541"), n, F.lit("9"))))
    df = table(spark, d, "customer").select("c_custkey", raw.alias("raw_phone"))
    df = df.withColumn("phone", text.standard_phone(F.col("raw_phone")))
    return df.withColumn("valid_phone", text.valid_phone(F.col("phone")))


@query("name_split", """
with words as (select conv_id, turn, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') as w from conversations)
select conv_id, turn, w[1] as first_name, w[2] as middle_name,
  case when len(w) > 2 then array_to_string(w[3:], ' ') end as last_name from words""")
def name_split(spark, d):
    df = table(spark, d, "conversations").select("conv_id", "turn", text.split_names(F.col("text")).alias("n"))
    return df.select("conv_id", "turn", "n.*")


@query("title_names", """
select p_partkey, upper(substr(l, 1, 1)) || lower(substr(l, 2)) as clean_name from (
  select p_partkey, regexp_replace(p_name || ' 24-b', '[^\\p{L}]', '', 'g') as l from part)""")
def title_names(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", text.letters_title(F.concat(F.col("p_name"), F.lit(" 24-b"))).alias("clean_name"))


@query("special_characters", """
select page_id, replace(replace(replace(replace(replace(replace(replace(html || '½a¿~�ïÂÃ¯', '½',''), '¿',''), '~',''), '�',''),
  'ï',''), 'Â',''), 'Ã¯','') as clean_html from pages""")
def special_characters(spark, d):
    dirty = F.concat(F.col("html"), F.lit("½a¿~�ïÂÃ¯"))
    return table(spark, d, "pages").select("page_id", text.drop_special_characters(dirty).alias("clean_html"))


@query("amount_text", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, format('{:,.2f}', l_extendedprice) as shown, l_extendedprice as parsed,
  replace(format('{:.2f}', l_extendedprice), '.', '') as minor_units from lineitem""")
def amount_text(spark, d):
    df = table(spark, d, "lineitem").withColumn("shown", F.format_number("l_extendedprice", 2))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "shown", text.parse_amount(F.col("shown")).alias("parsed"),
                     text.minor_units(F.col("l_extendedprice")).alias("minor_units"))


@query("date_text", """
with raw as (select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y%m%d') || '.0'
  when 1 then strftime(o_orderdate, '%d/%m/%Y') || ' 10:15' when 2 then strftime(o_orderdate, '%d-%m-%Y') || ' 10:15:30' else 'n/a' end as raw_date,
  o_orderkey % 4 as k, o_orderdate from orders)
select o_orderkey, raw_date, case when k = 0 then cast(o_orderdate as date) end as compact_date,
  case k when 1 then o_orderdate + interval '10 hours 15 minutes' when 2 then o_orderdate + interval '10 hours 15 minutes 30 seconds' end as parsed_at,
  strftime(o_orderdate, '%d-%b-%Y') as reported from raw""")
def date_text(spark, d):
    kind, day = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = (F.when(kind == 0, F.concat(F.date_format(day, "yyyyMMdd"), F.lit(".0")))
           .when(kind == 1, F.date_format(day, "dd/MM/yyyy' 10:15'")).when(kind == 2, F.date_format(day, "dd-MM-yyyy' 10:15:30'"))
           .otherwise("n/a"))
    df = table(spark, d, "orders").select("o_orderkey", raw.alias("raw_date"), "o_orderdate")
    at = text.parse_timestamp(F.col("raw_date"), "dd/MM/yyyy HH:mm", "dd-MM-yyyy HH:mm:ss").cast("timestamp_ntz")
    return df.select("o_orderkey", "raw_date", text.compact_date(F.col("raw_date")).alias("compact_date"), at.alias("parsed_at"),
                     dates.report_date(F.col("o_orderdate")).alias("reported"))


@query("required_fields", """
with dump as (select o_orderkey, nullif(o_orderstatus, 'P') as status, case when o_totalprice >= 20000 then o_totalprice end as amount from orders)
select o_orderkey, status, amount, status is null or amount is null as has_missing_fields from dump""")
def required_fields(spark, d):
    dump = table(spark, d, "orders").select(
        "o_orderkey", text.null_if_equal(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.when(F.col("o_totalprice") >= 20000, F.col("o_totalprice")).alias("amount"))
    return dump.withColumn("has_missing_fields", text.any_missing("status", "amount"))


@query("code_mapping", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  cast(case l_linenumber when 1 then 1 when 2 then 7 when 3 then 21 else -1 end as bigint) as loan_term,
  case when l_returnflag = 'R' then 'Duplicate Repayment' when l_returnflag = 'A' then 'accepted' else 'note: other' end as reason from lineitem""")
def code_mapping(spark, d):
    df = table(spark, d, "lineitem")
    code = F.concat(F.lit("1000"), F.col("l_linenumber").cast("string"))
    note = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("row "), F.col("l_linenumber").cast("string"), F.lit(": Duplicate Repayment found"))
                  ).when(F.col("l_returnflag") == "A", "accepted").otherwise("note: other")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     text.map_codes(code, {"10001": 1, "10002": 7, "10003": 21}, F.lit(-1)).cast("long").alias("loan_term"),
                     text.canonical_reason(note, "Duplicate Repayment").alias("reason"))


@query("string_functions", """
with s as (select o_orderkey, o_orderpriority as p, 'Disbursement to shop' || o_custkey || ' - Outlet ' || o_orderkey as details from orders)
select o_orderkey, substr(p, 1, 1) as code, split_part(p, '-', 2) as label, lower(p) as lowered, cast(length(p) as bigint) as n_chars,
  replace(p, '-', '/') as replaced, lpad(cast(o_orderkey as varchar), 12, '0') as padded,
  cast(position('-' in p) as bigint) as dash_at, substr(p, 1, length(p) - 2) as without_last_two,
  regexp_extract(details, 'shop\\d+') as shop, regexp_matches(p, '(?i)high|urgent') as is_pressing, 'id_' || o_orderkey as tagged from s""")
def string_functions(spark, d):
    p = F.col("o_orderpriority")
    details = F.concat(F.lit("Disbursement to shop"), F.col("o_custkey").cast("string"), F.lit(" - Outlet "), F.col("o_orderkey").cast("string"))
    return table(spark, d, "orders").select(
        "o_orderkey", F.substring(p, 1, 1).alias("code"), F.split_part(p, F.lit("-"), F.lit(2)).alias("label"), F.lower(p).alias("lowered"),
        F.length(p).cast("long").alias("n_chars"), F.replace(p, F.lit("-"), F.lit("/")).alias("replaced"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("padded"), F.position(F.lit("-"), p).cast("long").alias("dash_at"),
        F.substr(p, F.lit(1), F.length(p) - 2).alias("without_last_two"),
        F.regexp_extract(details, r"\w+(?=\s*-\s*)", 0).alias("shop"), p.rlike("(?i)high|urgent").alias("is_pressing"),
        F.concat(F.lit("id_"), F.col("o_orderkey").cast("string")).alias("tagged"))


@query("date_functions", """
select o_orderkey, cast(year(o_orderdate) as bigint) as y, cast(month(o_orderdate) as bigint) as m, cast(o_orderdate as date) as day,
  last_day(o_orderdate) as month_end, cast(date_trunc('month', o_orderdate) as date) as month_start,
  cast(cast(o_orderdate as date) + interval 1 month as date) as next_month,
  cast(date '2001-08-01' - cast(o_orderdate as date) as bigint) as days_ago,
  round((date '2001-08-01' - cast(o_orderdate as date)) / 30.436875, 6) as months_ago,
  cast((date '2001-08-01' - cast(o_orderdate as date)) // 365 as bigint) as whole_years,
  strftime(o_orderdate, '%Y%m%d%H%M%S') as stamp, o_orderdate + interval 3 hours as local_time from orders""")
def date_functions(spark, d):
    day, end = F.to_date("o_orderdate"), F.lit(dates.as_date(AS_OF))
    return table(spark, d, "orders").select(
        "o_orderkey", F.year(day).cast("long").alias("y"), F.month(day).cast("long").alias("m"), day.alias("day"),
        F.last_day(day).alias("month_end"), F.trunc(day, "MM").alias("month_start"), F.add_months(day, 1).alias("next_month"),
        F.datediff(end, day).cast("long").alias("days_ago"), F.round(dates.fractional_months(end, day), 6).alias("months_ago"),
        dates.age_years(day, AS_OF).cast("long").alias("whole_years"), F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("stamp"),
        dates.local_time(F.col("o_orderdate").cast("timestamp")).cast("timestamp_ntz").alias("local_time"))


@query("math_functions", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(ceil(l_extendedprice / 100) * 100 as double) as rounded_up,
  cast(case when l_extendedprice < 20000 then 0 when l_extendedprice > 80000 then 80000 else l_extendedprice end as double) as clamped,
  round_even(l_quantity / 4, 0) as halves, greatest(l_extendedprice - 50000, 0) as excess,
  coalesce(case when l_quantity > 25 then l_quantity end, 0) + coalesce(l_tax, 0) as total,
  case when l_linenumber = 1 then null else l_quantity / (l_linenumber - 1) end as ratio from lineitem""")
def math_functions(spark, d):
    price = F.col("l_extendedprice")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", numbers.round_up(price).alias("rounded_up"),
        numbers.clamp_limit(price, 20000, 80000).alias("clamped"), numbers.half_even(F.col("l_quantity") / 4).alias("halves"),
        F.greatest(price - 50000, F.lit(0.0)).alias("excess"),
        numbers.sum_of(F.when(F.col("l_quantity") > 25, F.col("l_quantity")), F.col("l_tax")).alias("total"),
        F.try_divide(F.col("l_quantity"), F.col("l_linenumber") - 1).alias("ratio"))


@query("band_lookup", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey,
  case when l_quantity < 10 then 'low' when l_quantity < 30 then 'mid' when l_quantity >= 30 then 'high' end as half_open,
  case when l_quantity <= 10 then 'low' when l_quantity > 10 and l_quantity <= 30 then 'mid' when l_quantity > 30 then 'high' end as right_closed,
  case when l_quantity between 1 and 9 then 'low' when l_quantity between 11 and 29 then 'mid' when l_quantity >= 31 then 'high' end as with_gaps
from lineitem""")
def band_lookup(spark, d):
    q = "l_quantity"
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.band(q, [(None, 10, "low"), (10, 30, "mid"), (30, None, "high")]).alias("half_open"),
        numbers.band(q, [(None, 10, "low"), (10, 30, "mid"), (30, None, "high")], "right").alias("right_closed"),
        numbers.band(q, [(1, 9, "low"), (11, 29, "mid"), (31, None, "high")], "both").alias("with_gaps"))


@query("json_fields", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, coalesce(json_extract_string(props, '$.code'), json_extract_string(props, '$.k')) as first_path,
  json_extract_string(props, '$.code') as absent from events""")
def json_fields(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"),
        payload.first_json_path(F.col("props"), "$.code", "$.k").alias("first_path"), F.get_json_object("props", "$.code").alias("absent"))


def _requests(spark, d):
    """Events as logged requests: doubly encoded JSON, some of it broken."""
    line = F.concat(F.lit('{"request": "'), F.col("props"), F.lit('",\n "amount": '), F.col("value").cast("decimal(12,2)").cast("string"), F.lit("}"))
    broken = F.concat(F.lit('{"request": '), F.col("props"))
    return table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", broken).otherwise(line).alias("raw_request"))


@query("payload_repair", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, value as amount from events where event_type <> 'error'""")
def payload_repair(spark, d):
    good, _ = payload.parse_payload(_requests(spark, d), "raw_request", "request struct<k: bigint>, amount double")
    return good.select("event_id", F.col("payload.request.k").alias("k"), F.col("payload.amount").alias("amount"))


@query("payload_rejects", "select event_id, '{\"request\": ' || props as raw_request from events where event_type = 'error'")
def payload_rejects(spark, d):
    _, bad = payload.parse_payload(_requests(spark, d), "raw_request", "request struct<k: bigint>, amount double")
    return bad.select("event_id", "raw_request")


REPORT = """
header struct<reportDate: string, clientName: string>,
scoreOutput struct<mobiLoansScore: int, grade: string>,
phoneList array<struct<phoneNumber: string, phoneType: string>>
"""


def _reports(spark, d):
    """Report texts with 0 to 5 phone nodes, parsed."""
    key, n = F.col("c_custkey").cast("string"), (F.col("c_custkey") % 6).cast("int")
    kind = lambda i: F.when(i % 2 == 1, "home").otherwise("work")
    phones = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(
        F.lit("<phoneList><phoneNumber>254"), i.cast("string"), key, F.lit("</phoneNumber><phoneType>"), kind(i), F.lit("</phoneType></phoneList>")))
    xml = F.concat(
        F.lit("<return><header><reportDate>2024-01-31</reportDate><clientName>"), F.col("c_name"),
        F.lit("</clientName></header><scoreOutput><mobiLoansScore>"), (F.col("c_custkey") % 900).cast("string"),
        F.lit("</mobiLoansScore><grade>"), F.col("c_mktsegment"), F.lit("</grade></scoreOutput>"), F.array_join(phones, ""), F.lit("</return>"))
    raw = table(spark, d, "customer").select(F.col("c_custkey").alias("client_id"), xml.alias("raw_response"))
    return raw.withColumn("report", F.from_xml("raw_response", " ".join(REPORT.split())))


@query("report_xml", """
select c_custkey as client_id, '2024-01-31' as report_date, c_name as client_name, cast(c_custkey % 900 as bigint) as mobi_loans_score,
  c_mktsegment as grade, c_custkey % 6 as phone_list_count, case when c_custkey % 6 > 0 then '2541' || c_custkey end as phone_list1_phone_number,
  case when c_custkey % 6 > 0 then 'home' end as phone_list1_phone_type,
  case when c_custkey % 6 > 1 then '2542' || c_custkey end as phone_list2_phone_number,
  case when c_custkey % 6 > 1 then 'work' end as phone_list2_phone_type from customer""")
def report_xml(spark, d):
    out = payload.flatten_report(_reports(spark, d), "report", {"phoneList": 2}, keep=("client_id",))
    return out.withColumns({c: F.col(c).cast("long") for c in ("mobi_loans_score", "phone_list_count")})


@query("report_lists", """
select c_custkey as client_id, 'phone_list' as list_name, i as position, '254' || i || c_custkey as phone_number,
  case when i % 2 = 1 then 'home' else 'work' end as phone_type
from (select c_custkey, unnest(range(1, c_custkey % 6 + 1)) as i from customer)""")
def report_lists(spark, d):
    out = payload.report_lists(_reports(spark, d), "report", keep=("client_id",))
    return out.select("client_id", "list_name", F.col("position").cast("long").alias("position"),
                      F.col("fields")["phone_number"].alias("phone_number"), F.col("fields")["phone_type"].alias("phone_type"))


@query("json_flatten", """
select o_orderkey as loan_id, o_custkey as client_id, u.kind as charge_kind, cast(u.amount as double) as charge_amount from orders,
  unnest([{'kind': 'principal', 'amount': o_totalprice}, {'kind': 'fee', 'amount': cast(o_orderkey % 50 as double)}]) as t(u)""")
def json_flatten(spark, d):
    item = lambda kind, amount: F.struct(F.lit(kind).alias("kind"), amount.cast("double").alias("amount"))
    doc = F.to_json(F.struct(
        F.struct(F.col("o_custkey").alias("id")).alias("client"),
        F.array(item("principal", F.col("o_totalprice")), item("fee", F.col("o_orderkey") % 50)).alias("charge")))
    raw = table(spark, d, "orders").select(F.col("o_orderkey").alias("loan_id"), F.from_json(
        doc, "client struct<id: bigint>, charge array<struct<kind: string, amount: double>>").alias("doc"))
    flat = payload.flatten_nested(raw.select("loan_id", "doc.client", "doc.charge"))
    return flat.select("loan_id", "client_id", "charge_kind", "charge_amount")


def _responses(spark, d):
    """Responses of one registry: three levels, two sibling arrays, and shapes that differ from row to row."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    paid = lambda i: F.struct((key % 10 + i).alias("day"), F.struct((key * i).alias("value")).alias("money"))
    loan = lambda i: F.struct(F.concat(F.lit("L"), key.cast("string"), F.lit(f"-{i}")).alias("ref"), F.when(key % 2 == 0, F.array(*[paid(j) for j in range(1, i + 2)])).alias("payments"))
    return o.select(key.alias("loan_id"), F.when(key % 11 == 0, F.lit("no json")).otherwise(F.to_json(F.struct(
        F.struct(F.col("o_custkey").alias("id"), F.struct(F.col("o_orderpriority").alias("band")).alias("risk")).alias("client"),
        F.when(key % 3 > 0, F.array(loan(1), loan(2))).alias("loans"), F.array(F.concat(F.lit("07"), key.cast("string")), F.col("o_orderstatus")).alias("contacts")))).alias("doc"))


@query("json_variant", """
with o as (select *, o_orderkey as k from orders where o_orderkey % 11 <> 0),
l as (select k, i, 'L' || k || '-' || i as ref from o, (values (1), (2)) v(i) where k % 3 > 0),
p as (select l.k, l.i, j from l, range(1, 4) r(j) where l.k % 2 = 0 and j <= l.i + 1)
select k as loan_id, '' as table_name, '' as row_path, 'client_id' as name, o_custkey::varchar as value from o
union all select k, '', '', 'client_risk_band', o_orderpriority from o
union all select k, 'loans', '/' || (i - 1), 'ref', ref from l
union all select k, 'loans.payments', '/' || (i - 1) || '/' || (j - 1), 'day', (k % 10 + j)::varchar from p
union all select k, 'loans.payments', '/' || (i - 1) || '/' || (j - 1), 'money_value', (k * j)::varchar from p
union all select k, 'contacts', '/0', 'value', '07' || k from o
union all select k, 'contacts', '/1', 'value', o_orderstatus from o""")
def json_variant(spark, d):
    """Sibling arrays become tables of their own; every value with its table, row and column."""
    rows = payload.variant_rows(_responses(spark, d), ["loan_id"], "doc", depth=6)
    return rows.select("loan_id", "table_name", "row_path", F.explode("fields").alias("name", "value"))


@query("variant_table", """
with l as (select o_orderkey as k, i from orders, (values (1), (2)) v(i) where o_orderkey % 11 <> 0 and o_orderkey % 3 > 0 and o_orderkey % 2 = 0)
select k as loan_id, '/' || (i - 1) || '/' || (j - 1) as row_path, '/' || (i - 1) as parent_path, k % 10 + j as day, cast(k * j as double) as money_value from l, range(1, 4) r(j) where j <= i + 1""")
def variant_table(spark, d):
    rows = payload.variant_rows(_responses(spark, d), ["loan_id"], "doc", depth=6)
    return payload.variant_table(rows, "loans.payments", {"day": "bigint", "money_value": "double"})


@query("names_by_score", """
with n as (select c_custkey, c_custkey % 101 as score, c_name as registry_first, c_mktsegment as registry_last, upper(c_name) as own_first, lower(c_mktsegment) as own_last from customer)
select c_custkey, case when score >= 60 then registry_first else own_first end as first_name,
  case when score >= 60 then registry_last else own_last end as last_name from n""")
def names_by_score(spark, d):
    first, last = text.pick_names(F.col("c_custkey") % 101, [F.col("c_name"), F.col("c_mktsegment")],
                                  [F.upper("c_name"), F.lower("c_mktsegment")])
    return table(spark, d, "customer").select("c_custkey", first.alias("first_name"), last.alias("last_name"))


@query("narration_split", """
select o_orderkey, split_part(o_orderpriority || ':' || o_orderstatus, ':', 1) as summary, o_orderstatus as code, cast(null as varchar) as extra from orders""")
def narration_split(spark, d):
    said = F.concat_ws(":", "o_orderpriority", "o_orderstatus")
    return table(spark, d, "orders").select("o_orderkey", *text.narration_parts(said, ("summary", "code", "extra")))


@query("birth_dates", """
with b as (select c_custkey, cast(c_custkey % 120 as integer) as years, date '2001-08-01' - cast((c_custkey % 120) * 365 + 5 as integer) as birth from customer)
select c_custkey, birth, cast((date '2001-08-01' - birth) // 365 as bigint) as age,
  case when (date '2001-08-01' - birth) // 365 < 18 or (date '2001-08-01' - birth) // 365 > 99 then date '1970-10-10' else birth end as used_birth from b""")
def birth_dates(spark, d):
    birth = F.date_sub(F.lit(dates.as_date(AS_OF)), ((F.col("c_custkey") % 120) * 365 + 5).cast("int"))
    df = table(spark, d, "customer").select("c_custkey", birth.alias("birth"))
    return df.select("c_custkey", "birth", dates.age_years(F.col("birth"), AS_OF).cast("long").alias("age"),
                     dates.plausible_birth_date(F.col("birth"), AS_OF).alias("used_birth"))
