"""One row per key, top rows per key, copies, and numbering inside groups.

Hot keys: a key may hold a large share of all rows. Rank filters are cut to
the wanted ranks on the map side (Spark plans a partial group limit), copies
are merged by a partial aggregate, and numbering can be split into slices of
the order column, so no single task ever has to hold a whole hot group.
"""
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.operators.slices import Slices


def _cols(columns) -> list:
    if isinstance(columns, (str, Column)):
        columns = [columns]
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def latest_per_key(df: DataFrame, keys, order, ties: str = "all") -> DataFrame:
    """Rows that rank first per key. ``order`` holds sort columns, best first.

    ties="all" keeps every row that ties for first place (``rank() = 1``);
    ties="one" keeps one row, so ``order`` should end with a unique column.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    place = F.rank() if ties == "all" else F.row_number()
    return df.withColumn("_place", place.over(w)).filter("_place = 1").drop("_place")


def top_n_per_key(df: DataFrame, keys, order, n: int) -> DataFrame:
    """Rows ranked 1..n per key, ties included."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))
    return df.withColumn("_place", F.rank().over(w)).filter(F.col("_place") <= n).drop("_place")


def pick_per_key(df: DataFrame, keys: list, order: list, largest: bool = True) -> DataFrame:
    """One whole row per key by a partial aggregate: the row with the largest
    (or smallest) ``order`` values. Nulls order below every value."""
    rest = [c for c in df.columns if c not in keys]
    if rest == order and len(rest) == 1:
        return df.groupBy(*keys).agg((F.max if largest else F.min)(rest[0]).alias(rest[0]))
    rank_by = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    best = (F.max if largest else F.min)(rank_by)
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def drop_exact_duplicates(df: DataFrame, payload: list, keep_first_by: list, ties: str = "all",
                          largest: bool = True) -> DataFrame:
    """Remove copies: rows equal on ``payload`` (nulls equal each other).

    Kept are the rows with the largest (or smallest) ``keep_first_by``.
    ties="one" merges copies map-side. ties="all" first aggregates the best
    order value per payload and then joins it back, a join that can be split
    when one payload is repeated very often.
    """
    if ties == "one":
        return pick_per_key(df, payload, keep_first_by, largest).select(df.columns)
    # Structs with null fields are equal when the same fields are null.
    rows = df.withColumns({"_copy": F.struct(*payload), "_order": F.struct(*keep_first_by)})
    best = rows.groupBy("_copy").agg((F.max if largest else F.min)("_order").alias("_order"))
    return rows.join(best, ["_copy", "_order"], "left_semi").select(df.columns)


def number_in_group(df: DataFrame, keys: list, order: list, name: str = "seq", slice_by: Column | Slices | None = None,
                    descending: bool = False) -> DataFrame:
    """1, 2, 3, … inside each group, in the total order given.

    ``slice_by`` is an expression that never falls along the order (a day of a
    timestamp), or ``Slices`` of the first order column. With it every (group,
    slice) is numbered on its own and shifted by the size of the slices before
    it, so a hot group is spread over its slices. ``keys=[]`` numbers the whole
    frame.
    """
    ordered = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    if slice_by is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*ordered)))
    # One struct column is the key of both the window and the join, so the rows
    # are shuffled once for the two.
    wide, place = (slice_by.on(df), slice_by.below(order[0])) if isinstance(slice_by, Slices) else (df, slice_by)
    sliced = wide.withColumn("_group", F.struct(*keys, place.alias("_slice"))).select(*df.columns, "_group")
    at = F.col("_group._slice")
    before = Window.partitionBy(*[F.col(f"_group.{k}") for k in keys]).orderBy(
        at.desc() if descending else at.asc()).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sliced.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.row_number().over(Window.partitionBy("_group").orderBy(*ordered))
    return sliced.withColumn("_inside", inside).join(shifts, "_group", "left").select(
        *df.columns, (F.col("_inside") + F.coalesce(F.col("_shift"), F.lit(0))).cast("long").alias(name))


def best_status_per_key(df: DataFrame, keys, status: str) -> DataFrame:
    """All rows whose status is the lowest of their key (dense rank 1; no status counts only where a key has none).

    The lowest status is a partial aggregate, joined back: rows that tie for it
    are never gathered in one task, as a join can be split where a sort of one
    key cannot.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    best = df.groupBy(*keys).agg(F.min(status).alias("_best")).select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_best")
    on = F.col(status).eqNullSafe(F.col("_best"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return df.join(best, on, "left_semi")


def average_rank(df: DataFrame, key: str, value: str, name: str = "avg_rank", slices: int | None = None) -> DataFrame:
    """Rank where ties share the mean of their places; null values have no rank.

    Works on one row per (key, value) with its multiplicity, in two levels:
    the rows of a key are summed up within slices of the values, and the slices'
    totals over the key, so a key with very many values is spread over as many
    tasks as there are slices. A key has at most that many totals.
    """
    at = Slices(df, value, slices)
    known = at.on(df.filter(F.col(value).isNotNull())).withColumn("_group", F.struct(F.col(key).alias("k"), at.below(value).alias("s")))
    counts = known.groupBy("_group", F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy("_group").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_group.k").orderBy("_group.s").rowsBetween(Window.unboundedPreceding, -1)
    shifts = known.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).select("_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    places = counts.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(shifts, "_group").select(
        F.col("_group.k").alias("_k"), "_v", (F.col("_shift") + F.col("_before") + (F.col("_n") + 1) / 2).alias(name))
    return df.join(places, (F.col(key) == F.col("_k")) & (F.col(value) == F.col("_v")), "left").drop("_k", "_v")


def first_two(df: DataFrame, key: str, order: list, columns: list) -> DataFrame:
    """Per key the columns of its best and second best row, side by side."""
    w = Window.partitionBy(key).orderBy(*_cols(order))
    two = df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= 2)
    out = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        for i in (1, 2):
            out.append(F.max(F.when(F.col("_place") == i, F.col(c))).alias(f"{c}_{i}"))
    return two.groupBy(key).agg(*out)


def uniquify(df: DataFrame, column: str, day: str, order: list, existing: DataFrame, existing_column: str,
             slice_by: Column | Slices | None = None) -> DataFrame:
    """Repeated values of a day get '_day_n'; values taken elsewhere get '_day'.

    ``order`` must be total. Null values are left alone. ``slice_by`` as in
    ``number_in_group``, for a placeholder value that very many rows share.
    """
    numbered = number_in_group(df.filter(F.col(column).isNotNull()), [column, day], order, "_n", slice_by=slice_by)
    suffixed = numbered.withColumn(
        column,
        F.when(F.col("_n") > 1, F.concat_ws("_", column, F.col(day).cast("string"), F.col("_n").cast("string")))
        .otherwise(F.col(column)),
    ).drop("_n")
    taken = existing.select(F.trim(F.col(existing_column)).alias("_taken")).filter("_taken is not null").distinct()
    marked = suffixed.join(taken, F.col(column) == F.col("_taken"), "left").withColumn(
        column,
        F.when(F.col("_taken").isNotNull(), F.concat_ws("_", column, F.col(day).cast("string"))).otherwise(F.col(column)),
    ).drop("_taken")
    return marked.unionByName(df.filter(F.col(column).isNull()))
