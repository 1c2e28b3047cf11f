"""Exact top-k search by inner product, with a table of distances to pivots.

Vectors are scaled, rounded down to whole numbers and stored in blocks, each
row with its distances to some pivots. For a query the pivots bound every
distance from below (the largest difference of two distances to one pivot),
and so every inner product from above: q.x = (|q|^2 + |x|^2 - d^2) / 2. A block's
vectors are evaluated in the order of their bounds until the next bound cannot
reach the k-th best score; what is left out is proven to be no answer.

Queries travel to the blocks, some MB of them in a pass, with the k-th best
score that a bounded sample gives them; a task keeps k rows for a query, and
sends those alone.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b

SCALE = 256
PIVOTS = 32
SAMPLE = 1024          # rows, of the least hashes, that pivots and first thresholds are taken from
SAMPLE_VALUES = 1 << 22  # components of the sample; longer vectors make it smaller, down to two rows
BLOCK_VALUES = 1 << 19  # components in a block
BLOCK_ROWS = 1 << 13
PASS_BYTES = 16 << 20  # of queries that are broadcast at once
TILE = 1 << 18         # bounds that are computed at once
PACKED = "block long, payload binary"
ASKED = "block long, n_bytes long, payload binary"
FOUND = "block long, place int, query_id long, vec_id long, score long"
KNOWN, ASKS = 1, 2     # flags of a row: it has an id; it is a query
LONGEST = (1 << 63) - 1
NO_ID = LONGEST        # place of rows without an id among ties: behind the others


class Rows(NamedTuple):
    """Vectors of one length, as whole numbers in doubles (exact for any double)."""
    ids: np.ndarray
    flags: np.ndarray
    values: np.ndarray   # a row for each vector
    squares: np.ndarray  # of the norms
    away: np.ndarray     # distances to the pivots, a row for each pivot


def _dot(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows; the shorter vectors are continued by zeros."""
    n = min(a.shape[1], c.shape[1])
    return a[:, :n] @ c[:, :n].T


@np.errstate(over="ignore")
def _squares(values: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", values, values)


@np.errstate(invalid="ignore", over="ignore")
def distances(values: np.ndarray, squares: np.ndarray, pivots: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(pivots), len(values)), np.float64)
    for row, pivot in zip(out, pivots):
        row[:] = np.sqrt(np.maximum(squares + pivot @ pivot - 2 * _dot(values, pivot[None, :])[:, 0], 0))
    return out


@np.errstate(invalid="ignore", over="ignore")
def choose_pivots(sample: list[np.ndarray], most: int = PIVOTS) -> list[np.ndarray]:
    """Vectors of the sample that are far from each other: each next one is the farthest from those before."""
    if not sample:
        return []
    chosen, width = [], max(map(len, sample))
    rows = np.zeros((len(sample), width))
    for row, v in zip(rows, sample):
        row[:len(v)] = v
    nearest, squares = np.full(len(rows), np.inf), _squares(rows)
    at = 0
    for _ in range(most):
        chosen.append(sample[at])
        nearest = np.minimum(nearest, np.maximum(squares + squares[at] - 2 * rows @ rows[at], 0))
        at = int(np.argmax(nearest))
        if nearest[at] == 0:
            break
    return chosen


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All components in a row, and the offsets of the vectors."""
    at = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]], at - at[0]


def _out(rows: Rows) -> bytes:
    return b.arrays_out(rows.ids, rows.flags, rows.values.ravel(), rows.squares, rows.away.astype(np.float32).ravel())


def _in(payload) -> Rows:
    ids, flags, values, squares, away = b.arrays_in(payload)
    return Rows(ids, flags, values.reshape(len(ids), -1), squares, away.reshape(-1, len(ids)))


def _pack(pivots):
    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def row(length: int) -> pa.RecordBatch:
            nonlocal made
            ids, flags, values = (np.concatenate(x) for x in zip(*held.pop(length)))
            values = values.reshape(len(ids), length)
            squares = _squares(values)
            made += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made - 1]), pa.array([_out(Rows(ids, flags, values, squares, distances(values, squares, pivots.value)))], pa.binary())],
                names=["block", "payload"])

        for batch in batches:
            column = batch.column("id")
            ids = column.fill_null(NO_ID).to_numpy().astype(np.int64)
            flags = (column.is_valid().to_numpy(zero_copy_only=False) * KNOWN | batch.column("asks").to_numpy(zero_copy_only=False) * ASKS).astype(np.uint8)
            values, at = _vectors(batch.column("vector"))
            lengths = np.diff(at)
            for length in np.unique(lengths).tolist():
                places = np.flatnonzero(lengths == length)
                step = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, length)))
                while len(places):
                    room = step - sum(len(x[0]) for x in held.get(length, ()))
                    some, places = places[:room], places[room:]
                    got = values[(at[some][:, None] + np.arange(length)).ravel()]
                    held.setdefault(length, []).append((ids[some], flags[some], np.floor(SCALE * got)))
                    if len(some) == room:
                        yield row(length)
            if len(held) > 64:  # of very many lengths
                yield from [row(length) for length in list(held)]
        yield from [row(length) for length in list(held)]
    return pack_rows


def _exact(q: np.ndarray, x: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of integer rows with one of them as long; ``bound`` is the product of the largest norms."""
    n = min(len(q), x.shape[1])
    if bound < 1 << 24:
        return (x[:, :n].astype(np.float32) @ q[:n].astype(np.float32)).astype(np.int64)
    if bound < 1 << 52:
        return (x[:, :n] @ q[:n]).astype(np.int64)
    whole = [int(v) for v in q[:n]]
    sums = [sum(a * int(c) for a, c in zip(whole, row)) for row in x[:, :n]]
    return np.array([max(-LONGEST, min(LONGEST, s)) for s in sums], np.int64)


class Best:
    """The k best rows of one query so far; ``least`` is a score that the k-th best is known to reach."""

    __slots__ = ("k", "least", "scores", "ids")

    def __init__(self, k: int, least: int):
        self.k, self.least, self.scores, self.ids = k, least, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        if not good.any():
            return
        scores, ids = np.concatenate((self.scores, scores[good])), np.concatenate((self.ids, ids[good]))
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


@np.errstate(invalid="ignore", over="ignore")
def bounds(asked: Rows, squares: np.ndarray, away: np.ndarray) -> np.ndarray:
    """No inner product is above: a row for each query. Distances are stored with 24 bits, so each is given away a little."""
    low = np.zeros((len(asked.ids), len(squares)), np.float32)
    one = np.empty_like(low)
    for q, x in zip(asked.away, away):
        np.subtract(q[:, None], x[None, :], out=one)
        np.abs(one, out=one)
        np.maximum(low, one, out=low)
    blur = 1e-6 * (asked.away.max(initial=0) + away.max(initial=0))
    sums = asked.squares[:, None] + squares[None, :]
    high = (sums - np.maximum(low - blur, 0).astype(np.float64) ** 2) / 2 + 1e-9 * sums + 0.5
    return np.where(np.isnan(high), np.inf, high)  # squares beyond a double bound nothing


def search_block(block: int, rows: Rows, asked_block: int, asked: Rows, best: list[Best], evaluated: list[int] | None = None) -> None:
    """Bring the queries' best rows up to date with a block. ``evaluated`` gets the number of inner products."""
    largest, tile = float(np.sqrt(rows.squares.max())), max(1, TILE // len(rows.ids))
    # float32 rows are made once for a block
    small = rows.values.astype(np.float32) if largest * float(np.sqrt(asked.squares.max())) < 1 << 24 else rows.values
    for at in range(0, len(asked.ids), tile):
        some = Rows(asked.ids[at:at + tile], asked.flags, asked.values[at:at + tile], asked.squares[at:at + tile], asked.away[:, at:at + tile])
        every = bounds(some, rows.squares, rows.away)
        for k, high in enumerate(every, at):
            mine = best[k]
            if block == asked_block:
                high[asked.flags[k]] = -np.inf
            left = np.flatnonzero(high >= mine.least)
            left = left[np.argsort(-high[left], kind="stable")]
            done, size = 0, 64
            while done < len(left) and high[left[done]] >= mine.least:
                chunk = left[done:done + size]
                if evaluated is not None:
                    evaluated.append(len(chunk))
                mine.add(_exact(asked.values[k], small[chunk], largest * float(np.sqrt(asked.squares[k]))), rows.ids[chunk])
                done, size = done + size, size * 2


def _ask(sample, k: int):
    """The queries of each block, with the k-th best score in the sample; in place of flags, the queries' places."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sample.value
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                rows = _in(payload)
                places = np.flatnonzero(rows.flags & ASKS)
                if not len(places):
                    continue
                least = np.full(len(places), -LONGEST, np.int64)
                for j, p in enumerate(places):
                    got = [_exact(rows.values[p], x, float(np.sqrt(rows.squares[p] * _squares(x).max())))[ids != rows.ids[p]] for ids, x in known]
                    got = np.sort(np.concatenate(got)) if got else np.zeros(0, np.int64)
                    if len(got) >= k:
                        least[j] = got[-k]
                value = b.arrays_out(rows.ids[places], places.astype(np.int32), rows.values[places].ravel(), rows.squares[places], rows.away[:, places].ravel(), least)
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(value)]), pa.array([value], pa.binary())], names=["block", "n_bytes", "payload"])
    return each


def _search(asked, k: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = []
        for block, payload in asked.value:
            ids, places, values, squares, away, least = b.arrays_in(pa.py_buffer(payload))
            queries.append((block, Rows(ids, places, values.reshape(len(ids), -1), squares, away.reshape(-1, len(ids))), [Best(k, int(x)) for x in least]))
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                rows = _in(payload)
                for asked_block, some, best in queries:
                    search_block(block, rows, asked_block, some, best)
        for block, some, best in queries:
            sizes = [len(x.ids) for x in best]
            ids = np.concatenate([x.ids for x in best])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), block)), pa.array(np.repeat(some.flags, sizes).astype(np.int32)), pa.array(np.repeat(some.ids, sizes)),
                 pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([x.scores for x in best]))],
                names=["block", "place", "query_id", "vec_id", "score"])
    return each


def _passes(asked: DataFrame, pass_bytes: int) -> list[tuple[int, int]]:
    """Ranges of blocks whose queries have ``pass_bytes`` together, or one block."""
    out: list[list[int]] = []
    held = 0
    for block, n in asked.select("block", "n_bytes").orderBy("block").collect():
        if not out or held + n > pass_bytes:
            out.append([block, block])
            held = 0
        out[-1][1], held = block, held + n
    return [(a, z) for a, z in out]


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, asks: Column | None = None, pivots: int = PIVOTS,
          pass_bytes: int = PASS_BYTES) -> DataFrame:
    """For each query its k rows of highest inner product: ``query_id, rank, vec_id, score``. Exact; ties go to the smaller id.

    Components are ``floor(256 * x)`` of the value as double. Queries are the rows with ``asks`` (default: ids divisible by 50), and every row
    but the query's own is a candidate, copies of the query's vector or of its id included.

    Vectors that are null or hold a null or non-finite component (or one that 256 takes beyond a double) take no part; the empty vector does,
    with score 0. Of two lengths the shorter vector is continued by zeros. Rows without an id answer, behind the others of a tie, and do not
    ask. Repeated rows ask and answer each. With fewer than k others a query gets them all, with none no row. Scores beyond a long are cut to
    its limits, and tie there. Other columns are ignored; an empty table gives no rows.

    Pivots and first thresholds come from a sample of 1,024 rows (fewer if they hold over 4,194,304 components) of least hashes; they decide how
    much is evaluated, never the result. Queries are broadcast ``pass_bytes`` at a time.
    """
    spark = vectors.sparkSession
    scratch = b.Scratch(spark, "pivot-search")
    sc = spark.sparkContext
    key = F.col(id_col).cast("long")
    fits = F.forall(F.col(vector_col).cast("array<double>"), lambda x: F.coalesce(F.abs(x * SCALE) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.filter(F.col(vector_col).isNotNull() & fits).select(
        key.alias("id"), F.coalesce(key % 50 == 0 if asks is None else asks & key.isNotNull(), F.lit(False)).alias("asks"),
        F.col(vector_col).cast("array<double>").alias("vector"))
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    chance = F.xxhash64("id", "vector")
    sample = rows.orderBy(chance, "id").limit(max(2, min(SAMPLE, SAMPLE_VALUES // max(1, longest)))).select("id", "vector").collect()
    whole = [(NO_ID if i is None else i, np.floor(SCALE * np.array(v, np.float64))) for i, v in sample]
    alike = [[x for x in whole if len(x[1]) == n] for n in sorted({len(v) for _, v in whole})]
    known = sc.broadcast([(np.array([i for i, _ in x], np.int64), np.stack([v for _, v in x])) for x in alike])
    far = sc.broadcast(choose_pivots([v for _, v in whole], pivots))
    packed = scratch.save(rows.mapInArrow(_pack(far), PACKED), "packed")
    asked = scratch.save(packed.mapInArrow(_ask(known, k), ASKED), "asked")
    found = []
    for n, (first, last) in enumerate(_passes(asked, pass_bytes)):
        queries = sc.broadcast([(r["block"], bytes(r["payload"])) for r in asked.filter(F.col("block").between(first, last)).select("block", "payload").collect()])
        found.append(scratch.save(packed.mapInArrow(_search(queries, k), FOUND), f"found{n}"))
        queries.unpersist()
    every = found[0] if found else spark.createDataFrame([], FOUND)
    for more in found[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("block", "place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
with usable as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.r, q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from usable q join usable c on q.r <> c.r where q.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by r order by score desc, vec_id nulls last) as place from pairs)
select query_id, place::int as rank, vec_id, score from ranked where place <= 5
"""
