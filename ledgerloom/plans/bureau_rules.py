"""Credit bureau reports: nested JSON per client → features → rules."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.text import parse_amount
from ledgerloom.operators.dedupe import pick_per_key

# Part of the report format that the rules read.
REPORT_SCHEMA = """
ConsumerHitResponse struct<BODY: struct<
  ClassificationInsType: array<struct<AMOUNT_OVERDUE: string, INSTITUTION_TYPE: string>>,
  ClassificationProdType: array<struct<AMOUNT_OVERDUE: string, PRODUCT_TYPE: string>>,
  CreditFacilityHistory24: array<struct<ACCOUNT_NUMBER: string, AMOUNT_OVERDUE_CAL: string, CURRENT_BALANCE_CAL: string,
    INSTITUTION_NAME: string, LOAN_STATUS: string, LOAN_TYPE_VALUE: string, NUM_OF_DAYS_IN_ARREARS_CAL: string>>,
  SummaryOfPerformance: array<struct<FACILITIES_COUNT: string, INSTITUTION_NAME: string, NONPERFORMING_FACILITY: string,
    OVERDUE_AMOUNT: string, PERFORMING_FACILITY: string>>>>
"""


def latest_reports(reports: DataFrame) -> DataFrame:
    """Newest report per client, parsed; ``body`` holds the report sections.
    Reports of the same time are told apart by their text."""
    newest = pick_per_key(reports.select("client_id", "created_at", "report"), ["client_id"], ["created_at", "report"])
    parsed = F.from_json("report", " ".join(REPORT_SCHEMA.split()))
    return newest.select("client_id", parsed.getField("ConsumerHitResponse").getField("BODY").alias("body"))


def report_features(reports: DataFrame, banks: list) -> DataFrame:
    """Facility and institution measures per client.

    Lists stay inside their row: they are folded with array functions, so no
    rows are made and none have to be grouped again.
    """
    facilities = F.coalesce(F.col("body.CreditFacilityHistory24"), F.array())
    amounts = F.transform(facilities, lambda f: F.coalesce(parse_amount(f["AMOUNT_OVERDUE_CAL"]), F.lit(0.0)))
    types = F.filter(F.transform(F.col("body.ClassificationInsType"), lambda i: i["INSTITUTION_TYPE"]), lambda t: t.isNotNull())
    return latest_reports(reports).select(
        "client_id",
        F.size(facilities).alias("total_no_of_facilities"),
        F.aggregate(amounts, F.lit(0.0), lambda total, x: total + x).alias("total_overdue_amount"),
        F.array_max(F.transform(facilities, lambda f: f["NUM_OF_DAYS_IN_ARREARS_CAL"].try_cast("int"))).alias("maximum_days_in_arrears"),
        F.size(F.array_distinct(types)).alias("no_of_institution_types"),
        F.coalesce(F.exists(facilities, lambda f: f["INSTITUTION_NAME"].isin(banks)), F.lit(False)).alias("at_deposit_bank"),
        F.to_json("body.CreditFacilityHistory24").alias("facilities_json"),
    )


def bureau_rules(summary: DataFrame, features: DataFrame) -> DataFrame:
    """Bureau qualification; a client without a report passes both rules."""
    out = summary.join(features, "client_id", "left")
    few, arrears = F.col("total_no_of_facilities") <= 5, F.col("maximum_days_in_arrears")
    overdue, kinds = F.col("total_overdue_amount"), F.col("no_of_institution_types")
    passes = few & (arrears < 60) & (overdue < F.col("average_monthly_6m")) & (kinds <= 2)
    payday = few & (arrears < 90) & (overdue < F.col("average_monthly_3m")) & (kinds <= 3) & F.col("at_deposit_bank")
    no_report = F.col("total_no_of_facilities").isNull()
    return out.withColumns({
        "bureau_qualified": no_report | F.coalesce(passes, F.lit(False)),
        "payday_bureau_qualified": no_report | F.coalesce(payday, F.lit(False))})


def product_overdue(reports: DataFrame) -> DataFrame:
    """One row per client and product class of the newest report."""
    items = latest_reports(reports).select("client_id", F.explode("body.ClassificationProdType").alias("p"))
    return items.select("client_id", F.col("p.PRODUCT_TYPE").alias("product_type"),
                        parse_amount(F.col("p.AMOUNT_OVERDUE")).alias("amount_overdue"))


# Lists of a report body with their fields; amounts come as text with thousands separators.
SECTIONS = {
    "institutions": ("ClassificationInsType", ("AMOUNT_OVERDUE", "INSTITUTION_TYPE")),
    "products": ("ClassificationProdType", ("AMOUNT_OVERDUE", "PRODUCT_TYPE")),
    "facilities": ("CreditFacilityHistory24", (
        "ACCOUNT_NUMBER", "AMOUNT_OVERDUE_CAL", "ASSET_CLASSIFICATION_CAL", "CURRENT_BALANCE_CAL", "DATE_REPORTED", "INSTITUTION_NAME",
        "DATE_REPORTED_AGE", "LOAN_STATUS", "LOAN_TYPE_VALUE", "MATURITY_DT", "NUM_OF_DAYS_IN_ARREARS_CAL")),
    "performance": ("SummaryOfPerformance", (
        "FACILITIES_COUNT", "INSTITUTION_NAME", "NONPERFORMING_FACILITY", "OVERDUE_AMOUNT", "PERFORMING_FACILITY")),
}
AMOUNTS = ("AMOUNT_OVERDUE", "AMOUNT_OVERDUE_CAL", "CURRENT_BALANCE_CAL", "FACILITIES_COUNT", "OVERDUE_AMOUNT")
# Single parts of a report body.
DETAILS = {"report": ("ReportDetailBVN", ("CIR_NUMBER", "REPORT_ORDER_DATE")),
           "score": ("CREDIT_SCORE_SUMMARY", ("CREDIT_SCORE", "CREDIT_RATING"))}


def _newest_body(reports: DataFrame, part: str, kind: str) -> DataFrame:
    newest = pick_per_key(reports.select("client_id", "created_at", "report"), ["client_id"], ["created_at", "report"])
    parsed = F.from_json("report", f"ConsumerHitResponse struct<BODY: struct<{part}: {kind}>>")
    return newest.select("client_id", parsed.getField("ConsumerHitResponse").getField("BODY").getField(part).alias("part"))


def section_rows(reports: DataFrame, section: str) -> DataFrame:
    """All rows of one list of each client's newest report, every field under its
    lower-case name; amounts as numbers, days in arrears as whole numbers."""
    part, fields = SECTIONS[section]
    rows = _newest_body(reports, part, f"array<struct<{', '.join(f'{f}: string' for f in fields)}>>").select("client_id", F.explode("part").alias("r"))

    def typed(f):
        c = F.col(f"r.{f}")
        return parse_amount(c) if f in AMOUNTS else c.try_cast("int") if f.startswith("NUM_OF_DAYS") else c
    return rows.select("client_id", *[typed(f).alias(f.lower()) for f in fields])


def report_details(reports: DataFrame, detail: str) -> DataFrame:
    """One single part of each client's newest report; a report without it has nulls."""
    part, fields = DETAILS[detail]
    rows = _newest_body(reports, part, f"struct<{', '.join(f'{f}: string' for f in fields)}>")
    return rows.select("client_id", *[F.col(f"part.{f}").alias(f.lower()) for f in fields])
