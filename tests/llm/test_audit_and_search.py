"""Filter audit and pivot search: against brute force, on awkward rows, and their parts."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import filter_audit, pivot_search
from ledgerloom.llm.queries import QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
LABELS = [(4, 1, 0), (5, 0, 1), (7, 1, 1), (8, 1, None), (9, None, 1), (9, 1, 0), (16, 1, 0), (None, 1, 1), (999, 1, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


# ---- filter audit

def test_survival_words():
    words = filter_audit.survival_words()
    assert all(bool(words[f] >> s & 1) == (f & s == 0) for f in range(32) for s in range(32))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 70_001])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert filter_audit.positional_popcount(words).tolist() == [int((words >> np.uint32(k) & 1).sum()) for k in range(32)]


def test_long_texts_are_read_in_spans(monkeypatch):
    raw = " ".join(f"Word{k % 700}\t" for k in range(5000)).encode()
    whole = filter_audit.failing(raw)
    for span in (1, 7, 100):
        monkeypatch.setattr(filter_audit, "SPAN", span)
        assert filter_audit.failing(raw) == whole and b"".join(filter_audit._spans(raw)) == raw


def test_audit(frame, awkward, labels, sure):
    rows = [*awkward, (30, "A#b " * 300, "a"), (31, "A#b " * 300, "b"), (32, "é" * 97 + "ABC", ""), (33, "é" * 96 + "ABC", ""), (-9, None, None)]
    got = [tuple(r) for r in filter_audit.audit(frame(rows), labels, part_col="source").collect()]
    assert sure(got) == sure(brute.audit(rows, LABELS))
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_audit_in_small_tasks(frame, awkward, labels, sure, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD", 2)
    words = np.arange(32, dtype=np.uint32)
    assert filter_audit.positional_popcount(words).sum() == 80
    got = [tuple(r) for r in filter_audit.audit(frame(awkward).repartition(5), labels, part_col="source").collect()]
    assert sure(got) == sure(brute.audit(awkward, LABELS))


def test_audit_adds_up(spark):
    rows = QUERIES["op13_filter_audit"](spark, FOLDER)
    n = {r["lang"] or "": r["n"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    for r in rows.filter("step = 5").groupBy("part", "filter_order").agg(F.max("kept").alias("kept")).join(
            rows.groupBy("part", "filter_order").agg(F.sum("removed").alias("gone")), ["part", "filter_order"]).collect():
        assert r["kept"] + r["gone"] == n[r["part"]]


def test_audit_of_nothing(frame, labels):
    assert filter_audit.audit(frame([]), labels, part_col="source").collect() == []
    assert filter_audit.audit(frame([(1, None, None)]), labels.limit(0), part_col="source").count() == 600


# ---- pivot search

def vectors(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, "x", None) for i, v in rows], f"vec_id long, embedding array<{kind}>, rank string, block string")


AWKWARD = [
    (0, [0.5, 0.25]), (0, [0.5, 0.25]), (50, [0.5, 0.25]), (100, [-1.0, 2.0, 0.0]), (150, []), (200, None), (250, [1.0, None]), (300, [float("nan"), 1.0]),
    (350, [float("inf")]), (400, [0.0, 0.0]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (None, [0.5, 0.25]), (None, [9.0, 9.0]), (-50, [0.001, -0.001]), (7, [1e6, 1e6]),
    (450, [1e6, -1e6]), (500, [1e18, 1.0]), (8, [1e18, -3.0, 5.0]), (9, [-1e300, 1e300]), (550, [1e300]),
]


def test_search_awkward(spark, sure):
    got = [tuple(r) for r in pivot_search.top_k(vectors(spark, AWKWARD)).collect()]
    assert sure(got) == sure(brute.top_k(AWKWARD))


@pytest.mark.parametrize("options", [{}, {"k": 1}, {"k": 60}, {"pivots": 1}, {"pass_bytes": 1}])
def test_search(spark, sure, options, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 5))
    rows = [(int(i), np.round(centres[i % 6] + rng.normal(size=5) * 0.1, 2).tolist()) for i in rng.permutation(700)]
    got = [tuple(r) for r in pivot_search.top_k(vectors(spark, rows, "float"), **options).collect()]
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in rows]
    assert sure(got) == sure(brute.top_k(rows, options.get("k", 5)))


def test_search_few_rows(spark):
    assert pivot_search.top_k(vectors(spark, [])).collect() == []
    assert pivot_search.top_k(vectors(spark, [(50, None), (100, [None])])).collect() == []
    assert pivot_search.top_k(vectors(spark, [(50, [1.0])])).collect() == []
    assert [tuple(r) for r in pivot_search.top_k(vectors(spark, [(50, [1.0]), (3, [2.0])])).collect()] == [(50, 1, 3, 256 * 512)]


def test_own_queries(spark):
    rows = [(i, [float(i % 7), float(i % 3)]) for i in range(40)]
    got = pivot_search.top_k(vectors(spark, rows), k=2, asks=F.col("vec_id").isin(3, 5)).collect()
    assert sorted({r["query_id"] for r in got}) == [3, 5] and len(got) == 4


def test_bounds_hold_and_stop():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 200
    values = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 8)
    squares = pivot_search._squares(values)
    pivots = pivot_search.choose_pivots(list(values[:500]), 24)
    away = pivot_search.distances(values, squares, pivots).astype(np.float32)
    rows = pivot_search.Rows(np.arange(4000), np.ones(4000, np.uint8), values, squares, away)
    asked = pivot_search.Rows(np.arange(10), np.arange(10), values[:10], squares[:10], away[:, :10])
    assert (pivot_search.bounds(asked, squares, away) >= values[:10] @ values.T).all()
    best, work = [pivot_search.Best(5, -pivot_search.LONGEST) for _ in range(10)], []
    pivot_search.search_block(1, rows, 1, asked, best, work)
    for k in range(10):
        scores = (values @ values[k]).astype(np.int64)
        scores[k] = -pivot_search.LONGEST
        order = np.lexsort((np.arange(4000), -scores))[:5]
        assert best[k].ids.tolist() == order.tolist() and best[k].scores.tolist() == scores[order].tolist()
    assert sum(work) < 10 * 4000 / 4  # bounds leave most rows out where vectors have clusters
