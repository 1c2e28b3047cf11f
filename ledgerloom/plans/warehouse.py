"""Building the versioned loan fact."""
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.operators.extract import resolve_keys, with_model_version
from ledgerloom.operators.merge import scd2_merge


def build_loan_fact(loans: DataFrame, dims: dict, enums: DataFrame, versions: DataFrame, current: DataFrame, tracked: list,
                    as_of) -> DataFrame:
    """Keys, model version, versioned merge, and one current row per loan.

    ``dims`` holds clients, products, statuses and officers. The model version
    a loan already has is never replaced and does not count as a change.
    """
    ready = resolve_keys(loans, dims["clients"], dims["products"], dims["statuses"], dims["officers"], enums)
    known = current.filter("is_current and model_version is not null").select("loan_id", "model_version")
    ready = with_model_version(ready, known, versions)
    merged = scd2_merge(current, ready, ["loan_id"], tracked, as_of, carried=("model_version",))
    # History passes; of several current rows of a loan the oldest stays. The merge is computed once.
    place = F.row_number().over(Window.partitionBy("loan_id", "is_current").orderBy("valid_from", *tracked, "model_version"))
    return merged.withColumn("_place", place).filter(~F.col("is_current") | (F.col("_place") == 1)).drop("_place")


def loan_summary(fact: DataFrame, clients: DataFrame, products: DataFrame, statuses: DataFrame) -> DataFrame:
    """Current facts with the client, product and status columns reports use."""
    return fact.filter("is_current").join(clients, "client_key").join(products, "product_key").join(statuses, "status_key", "left")


def with_month(fact: DataFrame, day: str) -> DataFrame:
    return fact.withColumns({"partition_year": F.year(day), "partition_month": F.month(day)})
