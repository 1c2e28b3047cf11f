"""A quality classifier: random Fourier features, ridge regression, isotonic calibration.

A document is described by statistics of its whole text. Cosines of random
projections of them approximate a Gaussian kernel; their normal equations are
summed partition by partition, so the fit sees every labelled row and the
driver only a matrix of fixed size. Scores are calibrated on labelled rows
that the fit did not see: counts in a fixed number of score bins, made
monotone by pooling neighbours.
"""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w

FEATURES = 256       # random Fourier features
WIDTH = 3.0          # of the kernel, in standard deviations of a statistic times the root of their number / 4
RIDGE = 1e-3         # per training row
FOLDS = 5            # rows with crc32(id) mod FOLDS = 0 are held out
CALIBRATE = 1        # fold that calibrates; the rest fit
BINS = 2000
ACCEPT = 0.3         # scores from here count as label 1

STATISTICS = ("log_bytes", "log_words", "mean_word", "spread_word", "letters", "capitals", "digits", "marks", "symbols", "beyond_ascii", "blanks",
              "word_kinds", "triple_kinds", "top_word", "log_line", "line_kinds", "symbol_words", "long_words", "short_words", "entropy", "stutter")
_CLASSES = np.stack([w._bytes((0x41, 0x5A), (0x61, 0x7A)), w._bytes((0x41, 0x5A)), w._bytes((0x30, 0x39)),
                     w._bytes((0x21, 0x22), (0x27, 0x29), (0x2C, 0x2F), (0x3A, 0x3B), (0x3F, 0x3F)),
                     w._bytes((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7F)), w._bytes((0x80, 0xFF)), w.BLANKS])
_SYMBOLS = w._bytes((0x21, 0x21), (0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x3E), (0x40, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[at])


def _kinds(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the distinct hashes and the count of the most frequent one (the upper 44 bits tell them apart)."""
    keys = np.sort(owner.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20))
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    text = (keys[heads] >> np.uint64(44)).astype(np.int64)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text, np.diff(np.append(heads, len(keys))))
    return np.bincount(text, minlength=n), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; null counts as empty, an empty text has zeros."""
    data, at = w.buffer(texts)
    n, size = len(at) - 1, np.diff(at).astype(float)
    found = w.find(data, at)
    n_words = np.diff(found.first).astype(float)
    per_byte, per_word = np.maximum(size, 1), np.maximum(n_words, 1)
    length = (found.end - found.start).astype(float)
    mean = _sums(length, found.first) / per_word
    spread = np.sqrt(np.maximum(_sums(length * length, found.first) / per_word - mean * mean, 0))
    shares = [_sums(c[data], at) / per_byte for c in _CLASSES]
    owner = found.text
    kinds, top = _kinds(found.hash, owner, n)
    full = w.whole(found.first, 3)
    triples = w.windows(found.hash, 3)[full]
    triple_kinds, _ = _kinds(triples, owner[:len(full)][full], n)
    lines = w.find(data, at, np.arange(256) != 0x0A)
    n_lines = np.maximum(np.diff(lines.first), 1)
    line_kinds, _ = _kinds(lines.hash, lines.text, n)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[data])))
    with_symbols = (symbols[found.end] > symbols[found.start]).astype(float)
    counts = np.bincount(np.repeat(np.arange(n), np.diff(at)) * 32 + (data >> 3), minlength=n * 32).reshape(n, 32) / per_byte[:, None]
    entropy = -(counts * np.log(np.where(counts > 0, counts, 1))).sum(axis=1)
    twice = np.zeros(len(found.hash))
    twice[1:] = (found.hash[1:] == found.hash[:-1]) & (owner[1:] == owner[:-1])
    some = size > 0
    columns = [np.log1p(size), np.log1p(n_words), mean, np.minimum(spread, 50), *shares, kinds / per_word,
               np.where(n_words > 2, triple_kinds / np.maximum(n_words - 2, 1), 1.0 * some), top / per_word, np.log1p(size / n_lines), line_kinds / n_lines,
               _sums(with_symbols, found.first) / per_word, _sums(length > 12, found.first) / per_word, _sums(length < 3, found.first) / per_word, entropy,
               _sums(twice, found.first) / per_word]
    out = np.stack(columns, axis=1)
    out[:, 2] = np.minimum(out[:, 2], 50)
    return out * some[:, None]


def _of_column(texts: pa.Array) -> np.ndarray:
    if not len(texts):
        return np.zeros((0, len(STATISTICS)))
    parts = pa.table({"text": texts})
    return np.concatenate([statistics(texts.slice(i, j - i)) for i, j in b.pieces(parts, size=1 << 20)])


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, statistics`` (doubles as bytes)."""
    def each(batches):
        for batch in batches:
            rows = _of_column(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["doc_id", "statistics"])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, "doc_id long, statistics binary")


def fold(doc_id, folds: int = FOLDS) -> F.Column:
    """crc32 of the id as text, modulo; rows without an id are in fold 0."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


class Model(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray    # raw scores
    levels: np.ndarray   # calibrated score at each

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return fourier((rows - self.centre) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(rows), self.edges, self.levels) if len(rows) else np.zeros(0)

    def column(self, text) -> F.Column:
        """The score of a text column."""
        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return pa.array(self.score(_of_column(texts)))
        return scored(text.cast("string"))


def fourier(rows: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised rows (cut at 6 deviations), the rows themselves, and a constant."""
    rng = np.random.default_rng(6)
    rows = np.clip(rows, -6, 6)
    spread = rng.normal(size=(rows.shape[1], FEATURES)) / (WIDTH * np.sqrt(rows.shape[1]) / 4)
    return np.hstack([np.cos(rows @ spread + rng.uniform(0, 2 * np.pi, FEATURES)) * np.sqrt(2 / FEATURES), rows / 10, np.ones((len(rows), 1))])


def _matrix(column) -> np.ndarray:
    width = len(STATISTICS)
    parts = [w.buffer(c)[0].copy().view(np.float64).reshape(-1, width) for c in (column.chunks if isinstance(column, pa.ChunkedArray) else [column])]
    return np.concatenate(parts) if parts else np.zeros((0, width))


def _summed(rows: DataFrame, size: int, terms) -> np.ndarray:
    """Sum of ``terms(statistics, labels)`` (a matrix of ``size`` rows) over all rows: one matrix per partition, added up by its rows."""
    def part(batches):
        total = None
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                some = batch.slice(i, 4096)
                one = terms(_matrix(some.column("statistics")), some.column("label").to_numpy(zero_copy_only=False))
                total = one if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size)), pa.array([r.tobytes() for r in total], pa.binary())], names=["k", "terms"])

    def add(key, table):
        total = sum(np.frombuffer(v, np.float64) for v in table.column("terms").to_pylist())
        return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "terms": pa.array([total.tobytes()], pa.binary())})
    found = rows.mapInArrow(part, "k long, terms binary").groupBy("k").applyInArrow(lambda key, table: add(key, table), "k long, terms binary")
    got = {r["k"]: np.frombuffer(r["terms"], np.float64) for r in found.collect()}
    return np.stack([got[k] for k in range(size)]) if got else np.zeros((0, 0))


def fit(rows: DataFrame) -> Model:
    """From ``doc_id, statistics, label`` (0 or 1). Without rows of the fitting folds every text scores 0.5; without rows to calibrate, raw scores cut to 0 and 1."""
    part = fold(F.col("doc_id"))
    fitting, checking = rows.filter((part != 0) & (part != CALIBRATE)), rows.filter(part == CALIBRATE)
    width = len(STATISTICS)
    moments = _summed(fitting, 3, lambda x, y: np.stack([np.full(width, float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)]))
    size = FEATURES + width + 1
    if not len(moments):
        return Model(np.zeros(width), np.ones(width), np.zeros(size), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    n, centre = moments[0, 0], moments[1] / moments[0]
    scale = np.sqrt(np.maximum(moments[2] / n - centre ** 2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)

    def normal(x, y):
        z = fourier((x - centre) / scale)
        return np.vstack([z.T @ z, z.T @ y])
    sums = _summed(fitting, size + 1, normal)
    weights = np.linalg.solve(sums[:size] + RIDGE * n * np.eye(size), sums[size])
    model = Model(centre, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def binned(batches):
        for batch in batches:
            raw = model.raw(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([pa.array(np.floor(np.clip(raw, -0.5, 1.5) * (BINS / 2)).astype(np.int64)), pa.array(raw), batch.column("label")],
                                             names=["bin", "raw", "label"])
    bins = (checking.select("statistics", "label").mapInArrow(binned, "bin long, raw double, label double")
            .groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("label").alias("ones"), F.count("*").alias("n")).orderBy("bin").collect())
    return model if not bins else model._replace(**isotonic(np.array([r["raw"] for r in bins]), np.array([r["ones"] for r in bins]), np.array([float(r["n"]) for r in bins])))


def isotonic(raw: np.ndarray, ones: np.ndarray, n: np.ndarray) -> dict:
    """Means of neighbouring bins pooled until they rise; scores in between are interpolated."""
    pools: list[list[float]] = []
    for x, k, m in zip(raw.tolist(), ones.tolist(), n.tolist()):
        pools.append([x, x, k, m])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, high, k1, m1 = pools.pop()
            pools[-1][1] = high
            pools[-1][2] += k1
            pools[-1][3] += m1
    edges = [e for low, high, _, _ in pools for e in ((low, high) if high > low else (low,))]
    levels = [k / m for low, high, k, m in pools for _ in range(2 if high > low else 1)]
    return {"edges": np.array(edges), "levels": np.array(levels)}


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[Model, DataFrame]:
    """The model, and the stored ``doc_id, statistics`` of all documents.

    All labelled rows outside the held-out fold are used. Rows without a label or an id teach nothing; a document with several labels
    has their mean; documents that repeat an id all count; labels of unknown documents are ignored.
    """
    scratch = b.Scratch(docs.sparkSession, "quality")
    known = scratch.save(described(docs, id_col, text_col), "statistics")
    label = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("label")).filter("label is not null")
    rows = scratch.save(known.join(label, known["doc_id"] == label["id"]).select("doc_id", "statistics", "label"), "labelled")
    return fit(rows), known


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null or empty text has all statistics 0 and the score of that; repeated rows score alike; ids only choose the fold;
    other columns are ignored; no documents, no rows; no labels, score 0.5.
    """
    model, known = trained(docs, labels, id_col, text_col, label_col)

    def each(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(_matrix(batch.column("statistics"))))], names=["doc_id", "score"])
    out = known.mapInArrow(each, "doc_id long, score double")
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
