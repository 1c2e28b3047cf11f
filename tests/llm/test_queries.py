"""Each registered query on a whole small table: against its SQL, or brute force; and the pipeline stage by stage."""
import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, compare
from ledgerloom.llm import blocks, quality, token_counts
from ledgerloom.llm.queries import ORACLES, QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{t}.parquet").collect()] for t in ("documents", "benchmark", "labels")}


@pytest.fixture(scope="module")
def texts(tables):
    return [(d[0], d[1]) for d in tables["documents"]]


def run(spark, name):
    return [tuple(r) for r in QUERIES[name](spark, FOLDER).collect()]


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    ok, note = compare(spark, con, FOLDER, name, QUERIES[name], ORACLES[name])
    assert ok, note


def test_native_queries_run_no_python(spark, plan):
    for name in ("op2_line_templates", "op10_fair_mix"):
        assert "Python" not in plan(QUERIES[name](spark, FOLDER)) and "Arrow" not in plan(QUERIES[name](spark, FOLDER))


def test_windows(spark, texts, sure):
    assert sure(run(spark, "op4_substring_dedup")) == sure(brute.substrings(texts))


def test_tokens(spark, texts, sure):
    known = token_counts.load()
    assert sure(run(spark, "op1_token_counts")) == sure(brute.tokens(texts, known.scores, known.unknown))


def test_tokens_of_a_small_table_of_words(texts, monkeypatch):
    """The trie and the table start afresh or lose their older half many times; counts stay."""
    known = token_counts.load()
    monkeypatch.setattr(token_counts, "NODES", 300)
    monkeypatch.setattr(token_counts, "WORDS", 400)
    counter = token_counts.Counter(known)
    some = texts[:40]
    assert [counter.total((t or "").encode().split()) for _, t in some] == [r[2] for r in brute.tokens(some, known.scores, known.unknown)]


def test_near(spark, texts, sure):
    assert sure(run(spark, "op5_near_duplicates")) == sure(brute.near(texts, 85))


def test_contamination(spark, texts, tables, sure):
    assert sure(run(spark, "op8_decontaminate")) == sure(brute.contamination(texts, [(i, t) for i, t in tables["benchmark"]]))


def test_earlier(spark, texts, sure):
    assert sure(run(spark, "op9_suffix_dedup")) == sure(brute.earlier(texts))


def test_scores(spark, texts, sure):
    got, want = sure(run(spark, "op7_ngram_scores")), sure(brute.scores(texts))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-6 * abs(w[5]) and abs(g[6] - w[6]) < 3e-4 * g[2] for g, w in zip(got, want))
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)  # context helps on text it has not seen


def test_mix_is_near_its_targets(spark, tables):
    got = run(spark, "op10_fair_mix")
    source = {d[0]: d[3] for d in tables["documents"]}
    _, _, target = brute.mix([(d[0], d[1], d[3]) for d in tables["documents"]])
    taken = {s: sum(g[4] for g in got if source[g[0]] == s) for s in target}
    most = max(g[1] for g in got)
    assert all(abs(taken[s] - t) <= most + 1 for s, t in target.items())
    assert run(spark, "op10_fair_mix") and sorted(got) == sorted(run(spark, "op10_fair_mix"))


def test_pipeline(spark):
    scratch = blocks.Scratch(spark, "stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.save(stage(spark, docs, FOLDER), f"s{k}")
        kept.append(([tuple(r) for r in docs.collect()], [tuple(r) for r in out.collect()]))
        assert out.columns == columns or k == 4
        docs = out
    (raw, good), (_, lines), (_, near), (_, clean), (_, mixed) = kept
    scored = {r["doc_id"]: r["score"] for r in quality.scored(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    assert {r[0] for r in good} == {r[0] for r in raw if scored[r[0]] >= 0.3}
    assert {r[0] for r in lines} == {r[0] for r in good} and all(r[4] == len(r[1]) for r in lines)
    wanted = {r[2] for r in brute.near([(r[0], r[1]) for r in lines], 80)}
    assert sorted(near) == sorted(r for r in lines if r[0] in wanted)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute.contamination([(r[0], r[1]) for r in near], items) if r[5]}
    assert sorted(clean) == sorted(r for r in near if r[0] not in bad) and bad
    assert {r[0] for r in mixed} == {r[0] for r in clean}
    assert corpus_pipeline.run(spark, FOLDER).count() == len(mixed)
