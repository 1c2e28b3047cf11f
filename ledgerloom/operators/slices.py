"""Slices of a table along one column, from the data's own ranges.

A hot key, or a table without a key, is worked slice by slice: each slice on its own, then shifted by (or carried over from)
the slices before it. The edges are percentiles, computed inside the plan by a scalar subquery, as many as the cluster has
shuffle partitions. A value that holds many rows is an edge several times; where the order allows, its rows are dealt over
all slices between.
"""
import math

from pyspark.sql import Column, DataFrame, functions as F

PER_PARTITION = 4  # slices for each shuffle partition, so that those of unequal size even out


class Slices:
    """Slices 0 to ``n`` - 1 of a column that the frame has."""

    def __init__(self, df: DataFrame, column, n: int | None = None):
        column = F.col(column) if isinstance(column, str) else column
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.n = n or max(2, PER_PARTITION * partitions)
        self.step = max(1, math.isqrt(self.n))
        shares = [k / self.n for k in range(1, self.n)]
        found = df.agg(F.percentile_approx(column, F.lit(shares), max(10_000, 20 * self.n)).alias("edges"))
        heads = F.expr(f"transform(sequence(0, size(edges) - 1, {self.step}), i -> edges[i])")
        self._edges = found.select(F.struct("edges", heads.alias("heads"))).scalar()

    def on(self, df: DataFrame) -> DataFrame:
        """The frame with a column ``_edges``, which the expressions below read (a subquery may not stand in a higher-order function itself)."""
        return df.withColumn("_edges", self._edges)

    def _count(self, value: Column, test) -> Column:
        # Two short searches: the block of edges by the blocks' first ones, then the place in it.
        edges = F.col("_edges")
        block = F.size(F.filter(edges["heads"], lambda e: test(e, value)))
        inside = F.size(F.filter(F.slice(edges["edges"], (block - 1) * self.step + 1, F.lit(self.step)), lambda e: test(e, value)))
        found = F.when(block == 0, 0).otherwise((block - 1) * self.step + inside)
        # An empty table or a null value has no place among the edges.
        return F.when(edges["edges"].isNull() | value.isNull(), 0).otherwise(found).cast("int")

    def below(self, value) -> Column:
        """How many edges are smaller: the slice of a value when all its rows stay together. It never falls along the column."""
        return self._count(F.col(value) if isinstance(value, str) else value, lambda e, v: e < v)

    def up_to(self, value) -> Column:
        """How many edges are smaller or equal: the last slice that rows of a value may be dealt to."""
        return self._count(F.col(value) if isinstance(value, str) else value, lambda e, v: e <= v)

    def dealt(self, value, chance: Column) -> Column:
        """A slice between ``below`` and ``up_to``, by a hash of the row."""
        low, high = self.below(value), self.up_to(value)
        return (low + F.pmod(chance, (high - low + 1).cast("long"))).cast("int")
