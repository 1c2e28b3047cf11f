"""Operational and regulatory reports."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.functions.dates import as_date, report_date
from ledgerloom.operators.dedupe import latest_per_key, number_in_group
from ledgerloom.operators.joins import day_spine, spine_join
from ledgerloom.operators.slices import Slices



MOST_ROWS = 1000  # of one source and receipt that travel as one list


def _lists(df: DataFrame, columns: dict, tag: str) -> DataFrame:
    """One source per receipt as lists of its distinct rows and how often each occurs. A receipt with very many distinct rows has
    several lists, dealt by a hash, so that no list grows with the receipt."""
    rows = df.filter("receipt_number is not null").groupBy(F.col("receipt_number").alias(f"_{tag}"), *[F.col(c).alias(name) for c, name in columns.items()]).agg(
        F.count(F.lit(1)).alias("n"))
    many = rows.groupBy(F.col(f"_{tag}").alias("_many")).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > MOST_ROWS)
    lists = F.coalesce(F.ceil(F.col("_rows") / MOST_ROWS), F.lit(1))
    dealt = rows.join(many, F.col(f"_{tag}") == F.col("_many"), "left").withColumn("_list", F.pmod(F.xxhash64(*columns.values()), lists))
    return dealt.groupBy(f"_{tag}", "_list").agg(F.collect_list(F.struct(*columns.values(), "n")).alias(f"_{tag}_rows")).drop("_list")


def traced(core: DataFrame, feed: DataFrame, dump: DataFrame) -> DataFrame:
    """Core transactions beside the feed's and the dumps' lists of the same receipt: repeated receipts are not multiplied."""
    f = _lists(feed, {"status_code": "feed_status", "kind": "feed_kind", "amount": "feed_amount"}, "f")
    d = _lists(dump, {"status_code": "dump_status", "kind": "dump_kind", "amount": "dump_amount"}, "d")
    return core.join(f, F.col("receipt_number") == F.col("_f"), "left").join(d, F.col("receipt_number") == F.col("_d"), "left")


def provenance(core: DataFrame, feed: DataFrame, dump: DataFrame) -> DataFrame:
    """Core transactions with what the live feed and the dumps know of them: a row for every pair of feed and dump rows of the receipt.

    The pairs are made in the last step, from lists that the joins carry as
    they are; rows that are equal stay one row with a count until then.
    """
    rows = traced(core, feed, dump).select("*", F.explode_outer("_f_rows").alias("_fr")).select("*", F.explode_outer("_d_rows").alias("_dr"))
    times = F.coalesce("_fr.n", F.lit(1)) * F.coalesce("_dr.n", F.lit(1))
    rows = rows.select("*", F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias("_copy"))
    fields = [F.col(f"_{side}r.{source}_{c}") for side, source in (("f", "feed"), ("d", "dump")) for c in ("status", "kind", "amount")]
    return rows.select(*core.columns, "_f", *fields[:3], "_d", *fields[3:], F.col("_f").isNull().alias("missing_in_feed"),
                       (F.col("_f").isNull() & F.col("_d").isNull()).alias("missing_in_dump"))


def _merged(df: DataFrame, key: str, columns: list, tag: str, amount: bool = True) -> DataFrame:
    """Rows of one source merged per key and status, with how many there were.
    A receipt that is repeated very often meets the core as one row."""
    rows = [F.count(F.lit(1)).cast("decimal(10,0)").alias(f"{tag}_n")]
    if amount:
        rows += [F.count("amount").cast("decimal(10,0)").alias(f"{tag}_count"), F.sum("amount").alias(f"{tag}_sum")]
    return df.groupBy(F.col(key).alias(f"_{tag}"), *[F.col(c).alias(f"{tag}_{c}") for c in columns]).agg(*rows)


def posting_summary(spark, core: DataFrame, feed: DataFrame, dump: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Per day of the last ``days`` days: volumes and values by where a
    transaction was processed. One aggregate gives all measures; days outside
    the window are cut before the joins. A core row counts once for every pair
    of feed and dump rows it meets; the merged sources carry those counts."""
    end = as_date(as_of)
    recent = core.filter(F.to_date("created_at").between(F.date_sub(F.lit(end), days), F.lit(end)))
    rows = recent.join(_merged(feed, "receipt_number", ["status_code", "kind"], "f"), F.col("receipt_number") == F.col("_f"), "left").join(
        _merged(dump, "receipt_number", ["status_code", "kind"], "d"), F.col("receipt_number") == F.col("_d"), "left")
    one = F.lit(1).cast("decimal(10,0)")
    nf, nd = F.coalesce("f_n", one), F.coalesce("d_n", one)
    counted = F.when(F.col("amount").isNotNull(), one)
    weigh = {"f": (F.col("f_count") * nd, F.col("f_sum") * nd), "d": (F.col("d_count") * nf, F.col("d_sum") * nf),
             "core": (counted * nf * nd, F.col("amount") * nf * nd)}
    no_feed, no_dump = F.col("_f").isNull(), F.col("_d").isNull()
    measures = []
    for kind in ("disbursement", "repayment"):
        in_dump, in_core = F.col("d_kind") == kind, F.col("kind") == kind
        feed_ok = (F.col("f_kind") == kind) & (F.col("f_status_code") == "200")
        feed_bad = (F.col("f_kind") == kind) & (F.col("f_status_code") == "400")
        dump_ok, dump_bad = F.col("d_status_code") == "200", F.col("d_status_code") == "400"
        for name, cond, side in (
            ("feed_ok", feed_ok, "f"),
            ("feed_failed", feed_bad, "f"),
            ("dump_ok_missing_in_feed", no_feed & dump_ok & in_dump, "d"),
            ("dump_ok_failed_in_feed", feed_bad & dump_ok & in_dump, "d"),
            ("manual_failed_in_both", feed_bad & dump_bad & in_core, "core"),
            ("manual_missing_in_both", no_feed & no_dump & in_core, "core"),
        ):
            volume, value = weigh[side]
            measures += [F.coalesce(F.sum(F.when(cond, volume)), F.lit(0)).cast("long").alias(f"{kind}_volume_{name}"),
                         F.sum(F.when(cond, value)).cast("double").alias(f"{kind}_value_{name}")]
    daily = rows.groupBy(F.to_date("created_at").alias("day")).agg(*measures)
    return spine_join(day_spine(spark, F.date_sub(F.lit(end), days), F.lit(end)), daily, "day")


def opt_in_summary(spark, clients: DataFrame, feed: DataFrame, dump: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Opt-ins per day by where they were processed, counted as above."""
    end = as_date(as_of)
    f, d = (_merged(df.filter("is_opt_in"), "store_number", ["status_code"], tag, amount=False) for df, tag in ((feed, "f"), (dump, "d")))
    recent = clients.filter(F.col("submitted_on").between(F.date_sub(F.lit(end), days), F.lit(end)))
    rows = recent.join(f, F.col("store_number") == F.col("_f"), "left").join(d, F.col("store_number") == F.col("_d"), "left")
    one = F.lit(1).cast("decimal(10,0)")
    weight = F.coalesce("f_n", one) * F.coalesce("d_n", one)
    no_feed, no_dump = F.col("_f").isNull(), F.col("_d").isNull()
    fs, ds = F.col("f_status_code"), F.col("d_status_code")
    count = lambda cond, name: F.coalesce(F.sum(F.when(cond, weight)), F.lit(0)).cast("long").alias(name)
    daily = rows.groupBy(F.col("submitted_on").alias("day")).agg(
        count(fs == "200", "feed_ok"), count(fs == "400", "feed_failed"), count(no_feed & (ds == "200"), "dump_ok_missing_in_feed"),
        count((fs == "400") & (ds == "200"), "dump_ok_failed_in_feed"), count((fs == "400") & (ds == "400"), "manual_failed_in_both"),
        count(no_feed & no_dump, "manual_missing_in_both"))
    return spine_join(day_spine(spark, F.date_sub(F.lit(end), days), F.lit(end)), daily, "day")


def feed_day(opt_ins: DataFrame, disbursements: DataFrame, repayments: DataFrame, day) -> DataFrame:
    """One row of totals for a day, from one pass over the three feeds."""
    day = as_date(day)
    rows = None
    for kind, df in (("opt_ins", opt_ins), ("disbursements", disbursements), ("repayments", repayments)):
        part = df.filter(F.to_date("ts") == F.lit(day)).select("ts", "amount", F.lit(kind).alias("kind"))
        rows = part if rows is None else rows.unionByName(part)
    of = lambda k: F.col("kind") == k
    return rows.agg(
        F.coalesce(F.max(F.when(~of("opt_ins"), F.col("ts"))), F.lit(day).cast("timestamp_ntz")).alias("as_at"),
        F.count_if(of("opt_ins")).alias("opt_ins"), F.count_if(of("disbursements")).alias("disbursements"),
        F.count_if(of("repayments")).alias("repayments"),
        F.coalesce(F.sum(F.when(of("disbursements"), F.col("amount"))).cast("double"), F.lit(0.0)).alias("disbursed"),
        F.coalesce(F.sum(F.when(of("repayments"), F.col("amount"))).cast("double"), F.lit(0.0)).alias("repaid"))


def numbered(df: DataFrame, key: str, slices, name: str = "row_id") -> DataFrame:
    """Report row numbers 1..n in the order of a key. Slices of it are numbered
    apart and shifted, so the report never has to fit one task. ``slices`` is the
    frame whose key gives their edges, as a report is costly to compute for them."""
    return number_in_group(df, [], [key], name, slice_by=Slices(slices, key))


def _prefix(code: str, c: str):
    return F.concat(F.lit(f"{code}_"), F.col(c).cast("string"))


def accounts(loans: DataFrame, clients: DataFrame, products: DataFrame, statuses: DataFrame, channels: DataFrame,
             lender_code: str, tenant: str, as_of) -> DataFrame:
    """Regulatory account list. Registry names win when they are similar enough."""
    name = F.when(F.col("similarity") >= 60, F.col("registry_name")).otherwise(F.col("client_name"))
    channel = channels.filter("channel_type = 'USSD'").agg(F.max("code")).scalar()
    out = loans.filter(F.col("loan_status").isin(300, 600, 700)).join(clients, "client_id").join(products, "product_id").join(
        statuses, "loan_status")
    out = numbered(out, "loan_id", loans)
    return out.select(
        "row_id", F.lit(lender_code).alias("lender_code"), report_date(F.lit(as_date(as_of))).alias("reporting_date"),
        _prefix(tenant, "client_id").alias("customer_id"), _prefix(tenant, "loan_id").alias("contract_number"),
        name.alias("account_name"), report_date(F.col("disbursed_on")).alias("disbursement_date"),
        F.col("principal").cast("double").alias("principal"), F.col("total_outstanding").cast("double").alias("outstanding"),
        F.coalesce(F.col("fees") + F.col("penalty"), F.lit(0)).cast("double").alias("other_charge"),
        channel.alias("channel"), F.col("repay_every").alias("tenor"), F.col("status_code").alias("account_status"))


def overdue_accounts(loans: DataFrame, clients: DataFrame, lender_code: str, tenant: str, as_of) -> DataFrame:
    """Active loans more than ninety days past maturity."""
    limit = F.date_add("matures_on", 90)
    out = loans.filter((F.col("loan_status") == 300) & (F.datediff(F.lit(as_date(as_of)), limit) >= 1)).join(
        clients.select("client_id"), "client_id")
    out = numbered(out, "loan_id", loans)
    return out.select(
        "row_id", F.lit(lender_code).alias("lender_code"), report_date(F.lit(as_date(as_of))).alias("reporting_date"),
        _prefix(tenant, "client_id").alias("customer_id"), _prefix(tenant, "loan_id").alias("contract_number"),
        report_date(F.date_add("matures_on", 90)).alias("overdue_date"),
        F.coalesce(F.col("principal_outstanding").cast("double"), F.lit(0.0)).alias("principal_arrears"),
        F.coalesce(F.col("total_outstanding").cast("double"), F.lit(0.0)).alias("outstanding"))


def last_repayments(loans: DataFrame, clients: DataFrame, repayments: DataFrame, lender_code: str, tenant: str, as_of) -> DataFrame:
    """Active loans with their last valid repayment; reversals and waivers, told
    by their receipt, do not count."""
    receipt = F.lower("receipt_number")
    valid = repayments.filter((F.col("is_reversed") == 0) & (
        F.col("receipt_number").isNull() | (~receipt.contains("_r") & ~receipt.contains("waiv"))))
    last = latest_per_key(valid, "loan_id", [F.col("paid_on").desc(), F.col("transaction_id").desc()])
    out = loans.filter("loan_status = 300").join(clients.select("client_id"), "client_id").join(
        last.select("loan_id", "paid_on"), "loan_id")
    out = numbered(out, "loan_id", loans)
    return out.select(
        "row_id", F.lit(lender_code).alias("lender_code"), report_date(F.lit(as_date(as_of))).alias("reporting_date"),
        _prefix(tenant, "client_id").alias("customer_id"), _prefix(tenant, "loan_id").alias("contract_number"),
        F.col("total_outstanding").cast("double").alias("outstanding"),
        report_date(F.col("paid_on")).alias("repayment_date"), F.col("principal_repaid").cast("double").alias("principal_repaid"))


def customers(clients: DataFrame, loans: DataFrame, genders: DataFrame, documents: DataFrame, lender_code: str, tenant: str,
              as_of) -> DataFrame:
    """Regulatory customer list: clients with a loan, a gender and a birth date.
    Without a surname the middle name takes its place."""
    known = clients.filter("gender is not null and birth_date is not null").join(
        loans.select("client_id").distinct(), "client_id", "left_semi")
    first, middle, last = text.pick_names(
        F.col("similarity"), [F.col("registry_first"), F.col("registry_middle"), F.col("registry_last")],
        [F.col("first_name"), F.col("middle_name"), F.col("last_name")])
    kind = F.when(F.col("national_id").rlike("[a-zA-Z]"), "Passport").otherwise("National Identity Card")
    out = known.withColumns({"_first": first, "_middle": middle, "_last": last, "document_type": kind}).join(
        documents.select(F.col("type").alias("document_type"), F.col("code").alias("document_code")), "document_type", "left").join(
        genders.select(F.col("type").alias("gender"), F.col("code").alias("gender_code")), "gender", "left")
    out = numbered(out, "client_id", clients)
    return out.select(
        "row_id", F.lit(lender_code).alias("lender_code"), report_date(F.lit(as_date(as_of))).alias("reporting_date"),
        _prefix(tenant, "client_id").alias("customer_id"), "document_code", "national_id", "gender_code",
        F.col("_first").alias("first_name"), F.when(F.col("_last").isNotNull(), F.col("_middle")).alias("middle_name"),
        F.coalesce("_last", "_middle").alias("surname"), report_date(F.col("birth_date")).alias("birth_date"),
        report_date(F.col("submitted_on")).alias("onboarding_date"), "mobile_number")
