"""Landed files → rows ready for an upsert."""
import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.functions.dates import as_date, shift_months
from ledgerloom.operators import merge
from ledgerloom.sources.readers import csv_after_preamble, latest_files, newest_files

# Statement columns in file order, lines before the data, time format.
STATEMENT_SCHEMA = ("receipt_number string, completion_time string, initiation_time string, details string, transaction_status string, "
                    "paid_in double, withdrawn double, balance double, balance_confirmed string, reason_type string, "
                    "other_party_info string, linked_transaction_id string, account_number string")
STATEMENT_PREAMBLE = 7
STATEMENT_TIME = "dd-MM-yyyy HH:mm:ss"


def statement_rows(spark, path: str, drop_last: int = 0) -> DataFrame:
    """Newest statement files, times parsed, direction told from the name of the file or its folder."""
    rows = latest_files(csv_after_preamble(spark, path, STATEMENT_SCHEMA, STATEMENT_PREAMBLE, drop_last))
    name = F.array_join(F.slice(F.split("file_name", "/"), -2, 2), "/")
    return rows.withColumns({
        "completion_time": text.parse_timestamp(F.col("completion_time"), STATEMENT_TIME),
        "initiation_time": text.parse_timestamp(F.col("initiation_time"), STATEMENT_TIME),
        "is_disbursement": name.contains("Disbursement"), "is_repayment": name.contains("Repayment")})


def load_statements(current: DataFrame, statement: DataFrame) -> DataFrame:
    """The stored statement lines with the newest delivery: a line is known by its receipt and details, and the last one counts."""
    return merge.upsert(current, statement.select(current.columns), ["receipt_number", "details"], ["completion_time", "initiation_time", "transaction_status"])


def replace_when_newer(spark, path: str, schema, pattern: str, stored: DataFrame, **options) -> DataFrame:
    """A list that each delivery replaces: the newest file's rows in place of the stored rows of the newest day, if the file is newer.

    The files' days come from the listing; a delivery that is not newer is not opened.
    """
    until = stored.agg(F.max("file_date")).first()[0]
    fresh = newest_files(spark, path, schema, pattern, loaded_until=until, **options)
    if fresh is None:
        return stored
    kept = stored.filter(F.col("file_date") != F.lit(until)) if until is not None else stored
    return kept.unionByName(fresh.select(stored.columns))


def location_mapping(current: DataFrame, delivered: DataFrame) -> DataFrame:
    """Places of shops, known by short code and till; a delivered row takes the place of the stored one."""
    rest = [c for c in current.columns if c not in ("short_code", "till_number")]
    return merge.upsert(current, delivered.select(current.columns), ["short_code", "till_number"], rest)


def whitelist_rows(spark, path: str, schema: str) -> DataFrame:
    """Whitelist export: ruler line below the header, row count at the end."""
    rows = csv_after_preamble(spark, path, schema, 2)
    return rows.withColumn("store_number", text.strip_decimal_suffix(F.col("store_number"))).filter(
        ~F.col("store_number").contains("rows"))


def till_activity(payments: DataFrame, day, as_of) -> DataFrame:
    """Payments of one day if it lies within the last three months; one range
    filter takes the place of a query per hour."""
    day = as_date(day)
    start, end = dt.datetime.combine(day, dt.time()), dt.datetime.combine(day + dt.timedelta(days=1), dt.time())
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    recent = F.col("transaction_time") >= at(dt.datetime.combine(shift_months(as_of, -3), dt.time()))
    return payments.filter((F.col("transaction_time") >= at(start)) & (F.col("transaction_time") < at(end)) & recent).withColumn(
        "balance", text.parse_amount(F.col("balance")))


def survey_answers(rows: DataFrame, text_columns: list) -> DataFrame:
    """Survey rows with line breaks and quotes taken out of the text."""
    return rows.withColumns({c: F.trim(F.regexp_replace(c, r"[\r\n\"']+", " ")) for c in text_columns})
