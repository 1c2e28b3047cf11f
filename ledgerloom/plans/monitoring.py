"""Core against warehouse, month by month."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.dates import as_date
from ledgerloom.operators.aggregate import monthly
from ledgerloom.operators.joins import reconcile
from ledgerloom.sources.sinks import replace_partitions


def transactions(core: DataFrame, warehouse: DataFrame, how: str = "inner") -> DataFrame:
    measures = {"total_count": F.count(F.lit(1)), "total_sum": F.sum("amount"), "penalty_sum": F.coalesce(F.sum("penalty"), F.lit(0))}
    one = lambda df: monthly(df.filter(F.col("transaction_type").isin(1, 2)), "transaction_date", **measures)
    return reconcile(one(core), one(warehouse), ["year", "month"], list(measures), how=how)


def clients(core: DataFrame, warehouse: DataFrame, how: str = "inner") -> DataFrame:
    one = lambda df: monthly(df, "submitted_on", total_count=F.count(F.lit(1)))
    return reconcile(one(core), one(warehouse), ["year", "month"], ["total_count"], how=how)


def loans(core: DataFrame, warehouse: DataFrame, how: str = "inner") -> DataFrame:
    measures = {
        "total_count": F.count(F.lit(1)), "principal_sum": F.sum("principal"), "outstanding_sum": F.sum("total_outstanding"),
        "count_active": F.count_if(F.col("loan_status") == 300), "count_closed": F.count_if(F.col("loan_status") == 600)}
    one = lambda df: monthly(df, "disbursed_on", **measures)
    return reconcile(one(core), one(warehouse), ["year", "month"], list(measures), how=how)


def backfill_months(report: DataFrame, as_of) -> DataFrame:
    """Past months with any difference: these have to be loaded again."""
    today = as_date(as_of)
    diffs = [c for c in report.columns if c.startswith("diff_")]
    differs = sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in diffs), F.lit(0)) > 0
    past = (F.col("year") < today.year) | ((F.col("year") == today.year) & (F.col("month") < today.month))
    return report.filter(differs & past).select("year", "month")


def reload_months(core: DataFrame, report: DataFrame, path: str, day: str, as_of) -> None:
    """Load the months that monitoring names again, in place: the stored table (by year and month) gets the core's rows of those
    months and keeps the files of all others. Monitoring names months that both sides have, so none is left without rows."""
    months = backfill_months(report, as_of)
    dated = core.withColumns({"year": F.year(day), "month": F.month(day)})
    on = months.select(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
    replace_partitions(dated.join(on, ["year", "month"], "left_semi"), path, ["year", "month"])


def whitelist(partner: DataFrame, results: DataFrame) -> DataFrame:
    """Totals of the partner's list against the newest model version."""
    from ledgerloom.sources.readers import as_of_latest

    def totals(df, side):
        return df.agg(F.count_if(F.col("blacklist_flag") == 1).alias(f"blacklisted_{side}"),
                      F.count_if(F.col("blacklist_flag") == 0).alias(f"whitelisted_{side}"),
                      *[F.sum(f"limit_{t}").alias(f"limit_{t}_{side}") for t in (1, 7, 21)])

    # Two rows of one side each, folded into one.
    rows = totals(partner, "partner").unionByName(totals(as_of_latest(results, "model_version"), "warehouse"), allowMissingColumns=True)
    both = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    for m in ("blacklisted", "whitelisted", "limit_1", "limit_7", "limit_21"):
        both = both.withColumn(f"diff_{m}", F.col(f"{m}_warehouse") - F.col(f"{m}_partner"))
    return both
