"""Name checks between own records, the operations list and the registry."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.similarity import with_token_scores
from ledgerloom.operators.dedupe import pick_per_key

# Batches in the order they are formed.
BATCHES = ("update_exact", "update_close", "names_swapped", "keep_id_match", "keep_all_exact", "keep_all_close",
           "keep_ops_exact", "consult")


def name_scores(names: DataFrame) -> DataFrame:
    """Three pairwise scores for rows that already share the national id.

    Rows of an id share names, and comparing costs far more than the rows
    weigh: each pair of names is compared once, whichever of the two comes
    first, and the pairs are dealt evenly over all tasks before: their bytes
    alone would put them into a few. A missing name scores nothing.
    """
    pairs = {"own_ops": ("own_name", "ops_name"), "own_registry": ("own_name", "registry_name"), "ops_registry": ("ops_name", "registry_name")}
    ends = {s: (F.when(F.col(a) <= F.col(b), F.col(a)).otherwise(F.col(b)), F.when(F.col(a) <= F.col(b), F.col(b)).otherwise(F.col(a))) for s, (a, b) in pairs.items()}
    asked = names.select(F.explode(F.array(*[F.struct(x.alias("_x"), y.alias("_y")) for x, y in ends.values()])).alias("pair")).select("pair.*")
    asked = asked.filter("_x is not null and _y is not null").distinct().repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    known = with_token_scores(asked, {"_score": ("_x", "_y")})
    out = names
    for s, (a, b) in pairs.items():
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        told = known.select(F.col("_x").alias("_kx"), F.col("_y").alias("_ky"), F.col("_score").alias("_ks"))
        out = out.withColumns({"_x": F.when(both, ends[s][0]), "_y": F.when(both, ends[s][1])}).join(
            told, (F.col("_x") == F.col("_kx")) & (F.col("_y") == F.col("_ky")), "left").withColumn(s, F.coalesce("_ks", F.lit(0))).drop("_x", "_y", "_kx", "_ky", "_ks")
    return out


def triage(names: DataFrame) -> DataFrame:
    """Score names and place each national id in a batch."""
    return triage_scored(name_scores(named(names)))


def named(names: DataFrame) -> DataFrame:
    """Rows to be scored: marked as of their id's latest opt-in day or not, then without names with digits."""
    newest = names.groupBy("national_id").agg(F.max("opt_in_date").alias("_newest")).withColumnRenamed("national_id", "_id")
    rows = names.join(newest, F.col("national_id") == F.col("_id")).withColumn("is_newest", F.col("opt_in_date").eqNullSafe(F.col("_newest")))
    return rows.drop("_id", "_newest").filter(~F.coalesce(F.col("ops_name").rlike(r"\d"), F.lit(False)))


def triage_scored(scored: DataFrame) -> DataFrame:
    """One exclusive batch per national id; ids of no batch are left out.

    Rows of the latest opt-in day can land in any batch, older rows in the last
    one only. An id lands in the first batch any of its rows qualifies for.
    """
    a, b, c = F.col("own_ops"), F.col("own_registry"), F.col("ops_registry")
    same_id = F.col("ops_id") == F.col("national_id")
    rules = (
        (a < 78) & (c == 100),
        (a < 78) & (c > 70) & (b != 100),
        (b != 100) & same_id & (c < 65),
        (a < 78) & same_id & (b == 100),
        (a == 100) & (b == 100) & (c == 100),
        (a >= 70) & (b >= 70) & (c >= 70),
        (a != 100) & (c == 100),
    )
    place = F.when(F.lit(False), F.lit(0))
    for i, rule in enumerate(rules):
        place = place.when(F.col("is_newest") & rule, F.lit(i))
    place = place.when(a < 65, F.lit(len(rules)))
    # Rows of no batch go after the aggregate: a filter on the scores before it
    # would be pushed under the join and have them computed twice.
    placed = scored.withColumn("_place", F.coalesce(place, F.lit(len(BATCHES))))
    one = pick_per_key(placed.select("national_id", "_place", "own_name", "ops_name", "registry_name", "own_ops",
                                     "own_registry", "ops_registry"), ["national_id"], ["_place", "ops_name"], largest=False)
    one = one.filter(F.col("_place") < len(BATCHES))
    return one.withColumn("batch", F.element_at(F.array(*[F.lit(x) for x in BATCHES]), F.col("_place") + 1)).drop("_place")
