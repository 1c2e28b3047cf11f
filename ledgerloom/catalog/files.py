"""Landed files and streams: tables are written out and read back whole."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query, table
from ledgerloom.operators import extract, ingest
from ledgerloom.operators.joins import day_spine
from ledgerloom.session import shared_dir
from ledgerloom.sources import readers, sinks
from ledgerloom.streaming import feeds

_DUMP = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _landed(spark, d):
    """The events as one folder of CSV files per day."""
    path = shared_dir(spark, "dump")
    sinks.export_daily(table(spark, d, "events"), path, "ts", sep="|")
    return path


def _dump(spark, path):
    return readers.csv_files(spark, path, _DUMP, "part-*", sep="|")


@query("dump_files", "select event_id, ts, user_id, event_type, value, props from events")
def dump_files(spark, d):
    return _dump(spark, _landed(spark, d)).select("event_id", "ts", "user_id", "event_type", "value", "props")


@query("latest_file_rows", "select event_id, value, cast(ts as date) as file_date from events where cast(ts as date) = (select max(cast(ts as date)) from events)")
def latest_file_rows(spark, d):
    return readers.newest_files(spark, _landed(spark, d), _DUMP, "part-*", sep="|").select("event_id", "value", "file_date")


@query("newer_files", "select event_id, value, cast(ts as date) as file_date from events where cast(ts as date) > date '2024-01-20'")
def newer_files(spark, d):
    return readers.newer_files(_dump(spark, _landed(spark, d)), dt.date(2024, 1, 20)).select("event_id", "value", "file_date")


@query("load_audit", """
with days as (select cast(unnest(generate_series(date '2023-12-30', date '2024-01-31', interval 1 day)) as date) as file_date), n as (select cast(ts as date) as file_date, count(*) as n_rows from events group by 1)
select 'events' as source, file_date, case when n_rows is null and file_date <> date '2023-12-31' then 0 else 1 end as n_files, coalesce(n_rows, 0) as n_rows, case when file_date = date '2023-12-31' then 'empty' when n_rows is null then 'missing' else 'loaded' end as status from days left join n using (file_date)""")
def load_audit(spark, d):
    days = day_spine(spark, F.lit(dt.date(2023, 12, 30)), F.lit(dt.date(2024, 1, 31)), "file_date")
    path = _landed(spark, d)
    # A file with a header and no rows.
    spark.createDataFrame([("|".join(c.split()[0] for c in _DUMP.split(", ")),)], "value string").coalesce(1).write.text(f"{path}/event_date=2023-12-31")
    return readers.load_audit(_dump(spark, path), readers.list_files(spark, path, "part-*"), "events", days)


@query("text_dump", "select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as segment from customer")
def text_dump(spark, d):
    path = shared_dir(spark, "text")
    sinks.export_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return readers.text_csv(spark, path, ["id", "name", "segment"], header=True).select("id", "name", "segment")


@query("published_json", "select o_orderkey as loan_id, o_totalprice as final_limit, o_orderpriority as reason from orders")
def published_json(spark, d):
    path = shared_dir(spark, "json")
    sinks.publish(table(spark, d, "orders").select(F.col("o_orderkey").alias("loan_id"), F.col("o_totalprice").alias("final_limit"), F.col("o_orderpriority").alias("reason")), path)
    return readers.json_lines(spark, path, "loan_id bigint, final_limit double, reason string")


@query("append_by_month", "select o_orderkey as loan_id, cast(month(o_orderdate) as bigint) as month from orders")
def append_by_month(spark, d):
    path = shared_dir(spark, "append")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("loan_id"), "o_orderstatus", F.month("o_orderdate").alias("month")).hint("rebalance", "month")
    sinks.append(rows.filter("o_orderstatus = 'F'"), path, ["month"])
    sinks.append(rows.filter("o_orderstatus <> 'F'"), path, ["month"])
    return spark.read.parquet(path).select("loan_id", F.col("month").cast("long").alias("month"))


def _events_stream(spark, d):
    # A pattern, as a stream takes folders and patterns but no single file.
    return feeds.parquet_stream(spark, f"{d}/events.*", table(spark, d, "events").schema)


@query("stream_unique_requests", "select distinct event_id from events")
def stream_unique_requests(spark, d):
    """The feed polled twice: the second delivery of a request is dropped."""
    path = shared_dir(spark, "unique")
    stream = _events_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("at", F.col("ts").cast("timestamp"))
    feeds.run_available(feeds.unique_requests(stream, "event_id", "at").select("event_id"), path, shared_dir(spark, "checkpoint"))
    return spark.read.parquet(path)


@query("stream_hourly", """
select date_trunc('hour', ts) as hour, count(*) as total_count, cast(sum(cast(value as decimal(18,2))) as double) as total_sum from events group by 1""")
def stream_hourly(spark, d):
    """All hours, in deliveries that are not in order of time."""
    landed = shared_dir(spark, "deliveries")
    table(spark, d, "events").select("ts", "value", "event_id").repartition(6, "event_id").write.parquet(landed)
    stream = spark.readStream.schema("ts timestamp_ntz, value double").option("maxFilesPerTrigger", 2).parquet(landed)
    stream = stream.select(F.col("ts").cast("timestamp").alias("ts"), F.col("value").cast("decimal(18,2)").alias("value"))
    out = feeds.hourly_totals(stream, "ts", "value", shared_dir(spark, "checkpoint"))
    return out.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "total_count", F.col("total_sum").cast("double").alias("total_sum"))


@query("stream_status_upserts", """
select user_id, event_type, event_id, ts from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as r from events) where r = 1""")
def stream_status_upserts(spark, d):
    """Three deliveries, then a run that finds nothing new."""
    landed, state = shared_dir(spark, "statuses"), shared_dir(spark, "checkpoint")
    table(spark, d, "events").select("user_id", "event_type", "ts", "event_id").repartition(3, "event_id").write.parquet(landed)
    for _ in range(2):
        stream = spark.readStream.schema("user_id bigint, event_type string, ts timestamp_ntz, event_id bigint").option("maxFilesPerTrigger", 1).parquet(landed)
        out = feeds.run_upserts(stream, state, ["user_id", "event_type"], ["ts", "event_id"])
    return out


@query("stream_csv_drop", "select event_id, event_type, value from events")
def stream_csv_drop(spark, d):
    """Daily files picked up as they are dropped, each once."""
    landed, path = shared_dir(spark, "drop"), shared_dir(spark, "loaded")
    sinks.export_daily(table(spark, d, "events"), landed, "ts")
    stream = feeds.csv_stream(spark, landed, _DUMP, "*.csv")
    feeds.run_available(stream.select("event_id", "event_type", "value"), path, shared_dir(spark, "checkpoint"))
    return spark.read.parquet(path)


@query("latin1_dump", "select c_custkey as id, 'Café ' || c_name as name from customer")
def latin1_dump(spark, d):
    path = shared_dir(spark, "latin1")
    sinks.export_csv(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Café "), "c_name").alias("name")), path, encoding="ISO-8859-1")
    return readers.csv_files(spark, path, "id bigint, name string", encoding="ISO-8859-1").select("id", "name")


def _documents(spark, d, head, foot, name):
    """Files of 500 customers each, with lines before and after the rows."""
    path = shared_dir(spark, name)
    rows = table(spark, d, "customer").groupBy(F.floor(F.col("c_custkey") / 500).alias("part")).agg(
        F.array_sort(F.collect_list(F.concat("c_custkey", F.lit(',"'), "c_name", F.lit(', "')))).alias("lines"))
    content = F.concat(F.lit(head), F.array_join("lines", "\n"), F.lit("\n("), F.size("lines").cast("string"), F.lit(foot))
    rows.select("part", content.alias("value")).write.partitionBy("part").text(path)
    return path


@query("preamble_files", "select c_custkey as id, c_name || ', ' as name from customer")
def preamble_files(spark, d):
    path = _documents(spark, d, "Report\nfor,you\nid,name\n", " rows affected)", "preamble")
    return readers.csv_after_preamble(spark, path, "id bigint, name string", 3, drop_last=1).select("id", "name")


@query("statement_files", """
with lines as (select 'R' || o_orderkey as receipt_number, case when o_custkey % 5 = 0 then 'Charge' else 'Payment' end as details, o_orderdate as completion_time, o_totalprice as paid_in,
  case when o_custkey % 7 = 0 then 'Shop, "' || o_orderkey || '"' || chr(10) || 'second line' else 'Shop ' || o_orderkey end as other_party_info, o_orderkey, o_orderstatus from orders),
stored as (select receipt_number, details, timestamp '1990-01-01' as completion_time, paid_in - 1 as paid_in, 'old' as other_party_info, false as is_disbursement from lines where o_orderkey % 4 = 0),
delivered as (select receipt_number, details, completion_time, paid_in, other_party_info, o_orderstatus = 'F' as is_disbursement from lines where o_orderstatus <> 'P' and o_orderkey % 3 < 2)
select * from delivered union all select * from stored where receipt_number not in (select receipt_number from delivered)""")
def statement_files(spark, d):
    """Statements as they are sent: lines before and after the rows, quoted line breaks; only the newest day's; then merged by receipt."""
    path = shared_dir(spark, "statements")
    o = table(spark, d, "orders")
    key, text_of = F.col("o_orderkey").cast("string"), lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    details = F.when(F.col("o_custkey") % 5 == 0, "Charge").otherwise("Payment")
    party = F.when(F.col("o_custkey") % 7 == 0, F.concat(F.lit('Shop, "'), key, F.lit('"\nsecond line'))).otherwise(F.concat(F.lit("Shop "), key))
    at = F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss")
    line = F.concat_ws(",", F.concat(F.lit("R"), key), at, at, details, F.lit("Completed"), F.col("o_totalprice").cast("string"), F.lit(""), F.lit("0"), F.lit("true"), F.lit("1 day"),
                       text_of(party), F.lit(""), F.lit(""))
    kinds = o.filter("o_orderstatus <> 'P' and o_orderkey % 3 < 2").select(
        F.concat(F.when(F.col("o_orderstatus") == "F", "Disbursements").otherwise("Repayments"), F.lit("-2024-01-05-"), F.floor(F.col("o_custkey") / 300).cast("string")).alias("part"), line.alias("line"))
    old = o.filter("o_orderstatus = 'P'").select(F.concat_ws("-", F.lit("Repayments-2024-01-04"), F.floor(F.col("o_custkey") / 300).cast("string")).alias("part"), line.alias("line"))
    lines = kinds.unionByName(old)
    # A file is written row by row: its head, its lines in order, its foot.
    sizes = lines.groupBy("part").agg(F.count(F.lit(1)).cast("string").alias("n"))
    head, foot = F.lit("Organisation\nShort code\nFrom\nTo\nPage\n\nReceipt No.,Completion Time"), F.concat(F.lit("Total,"), "n", F.lit("\nEnd of statement"))
    ends = sizes.select("part", F.explode(F.array(F.struct(F.lit(0).alias("place"), head.alias("value")), F.struct(F.lit(2).alias("place"), foot.alias("value")))).alias("end")).select("part", "end.*")
    rows = lines.select("part", F.lit(1).alias("place"), F.col("line").alias("value")).unionByName(ends)
    rows.repartition("part").sortWithinPartitions("part", "place", "value").drop("place").write.partitionBy("part").text(path)
    columns = ["receipt_number", "details", "completion_time", "initiation_time", "transaction_status", "paid_in", "other_party_info", "is_disbursement"]
    stored = o.filter("o_orderkey % 4 = 0").select(
        F.concat(F.lit("R"), key).alias("receipt_number"), details.alias("details"), F.lit(dt.datetime(1990, 1, 1)).cast("timestamp").alias("completion_time"),
        F.lit(None).cast("timestamp").alias("initiation_time"), F.lit("Completed").alias("transaction_status"), (F.col("o_totalprice") - 1).alias("paid_in"),
        F.lit("old").alias("other_party_info"), F.lit(False).alias("is_disbursement")).select(columns)
    out = ingest.load_statements(stored, ingest.statement_rows(spark, path, drop_last=2))
    return out.select("receipt_number", "details", F.col("completion_time").cast("timestamp_ntz").alias("completion_time"), "paid_in", "other_party_info", "is_disbursement")


@query("whitelist_files", "select cast(c_custkey as varchar) as store_number, c_name || ', ' as name from customer")
def whitelist_files(spark, d):
    path = _documents(spark, d, "Store,Name\n-----,----\n", " rows affected),", "whitelist")
    return ingest.whitelist_rows(spark, path, "store_number string, name string").select("store_number", "name")


@query("exception_files", "select o_orderkey as loan_id, case when o_orderkey % 3 = 0 then 'gender' else 'surname' end as exception_column from orders where o_orderkey % 3 < 2")
def exception_files(spark, d):
    path = shared_dir(spark, "exceptions")
    bad = table(spark, d, "orders").filter("o_orderkey % 3 < 2").select(
        F.col("o_orderkey").alias("loan_id"), F.when(F.col("o_orderkey") % 3 == 0, "gender").otherwise("surname").alias("exception_column"))
    sinks.export_exceptions(bad, path)
    return spark.read.schema("loan_id bigint, exception_column string").option("header", True).csv(path)


@query("full_overwrite", "select o_orderkey as loan_id, o_orderstatus as status from orders where o_orderstatus <> 'F'")
def full_overwrite(spark, d):
    path = shared_dir(spark, "overwrite")
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("loan_id"), F.col("o_orderstatus").alias("status"))
    sinks.overwrite(rows, path)
    sinks.overwrite(rows.filter("status <> 'F'"), path)
    return spark.read.parquet(path)


@query("loan_charges", """
select l_orderkey as loan_id, l_linenumber as charge, cast(l_tax as double) as amount, o_custkey as client_id
from lineitem left join (select * from orders where o_orderstatus = 'O') on l_orderkey = o_orderkey""")
def loan_charges(spark, d):
    """Charges with the client of their loan, if it is known, as a table of its own that each run replaces."""
    charges = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("loan_id"), F.col("l_linenumber").alias("charge"), F.col("l_tax").cast("double").alias("amount"))
    known = table(spark, d, "orders").filter("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("client_id"))
    path = shared_dir(spark, "charges")
    sinks.overwrite(extract.loan_charges(charges, known), path)
    return spark.read.parquet(path).select("loan_id", "charge", "amount", "client_id")
