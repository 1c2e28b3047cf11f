"""Whole jobs: what an operator must not leave out, on small inputs."""
from pyspark.sql import functions as F

from ledgerloom.llm import blocks, decontaminate, fuse_dedup, ngram_lm
from ledgerloom.llm.queries import QUERIES
from tests.llm import brute


def test_contexts_that_training_has_once_answer(spark):
    held = [i for i in range(200) if brute.held(i)]
    taught = [i for i in range(200) if not brute.held(i)]
    passage = " ".join(f"rare{k}" for k in range(40))
    rows = [(taught[0], "before " + passage + " after"), (held[0], "again " + passage), (taught[1], "one two three one two four"), (held[1], "one two three unseen")]
    got = {r["doc_id"]: r for r in ngram_lm.scored(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {r[0]: r[6] for r in brute.scores(rows)}
    assert all(abs(got[i]["score"] - want[i]) < 3e-4 * got[i]["n_tokens"] for i in want)
    assert got[held[0]]["score"] > got[held[0]]["base_score"] + 30  # the passage is known word by word


def test_every_context_answers_on_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    want = {r[0]: r[6] for r in brute.scores([(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])}
    got = QUERIES["op7_ngram_scores"](spark, folder).collect()
    assert {r["doc_id"] for r in got} == set(want)
    assert all(abs(r["score"] - want[r["doc_id"]]) < 3e-4 * r["n_tokens"] for r in got)


def test_blocks_close_on_rows_too(spark):
    n = blocks.BLOCK_ROWS + 5
    docs = spark.range(0, n, 1, 1).select("id", F.when(F.col("id") % 7 == 0, "").alias("text"))
    packed = blocks.pack(blocks.Scratch(spark, "rows"), docs, "id", "text").collect()
    assert sorted(r["n_texts"] for r in packed) == [5, blocks.BLOCK_ROWS] and len({r["block"] for r in packed}) == 2
    ids = [i for r in sorted(packed, key=lambda r: r["block"]) for i in blocks.pa.ipc.open_stream(r["payload"]).read_all().column("id").to_pylist()]
    assert ids == list(range(n))


def test_screening_decides_on_copies_of_the_snapshot(spark, monkeypatch):
    rows = [(1, "in both"), (2, "only early"), (3, "twice early"), (4, "twice early"), (60, "in both"), (61, "twice late"), (62, "twice late"), (63, "twice early"),
            (None, "in both"), (None, "twice  early"), (100, "only late")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, map(tuple, fuse_dedup.exact_dedup(docs).collect()))) == sorted(map(str, brute.exact(rows)))
    rows = [r for r in rows if r[0] not in (3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(fuse_dedup, "screened", lambda batch, snapshot: batch.withColumn("maybe", F.lit(False)))
    groups = {r["doc_id"]: r["group_size"] for r in fuse_dedup.exact_dedup(docs).collect() if r["doc_id"] is not None}
    assert groups[61] == groups[62] == 2 and groups[1] == 1  # a filter that loses its keys shows


def test_driver_reads_the_benchmark_pass_by_pass(spark, monkeypatch):
    words = [" ".join(f"item{i}w{k}" for k in range(20)) for i in range(6)]
    bench = spark.createDataFrame(list(enumerate(words)), "item_id long, text string")
    docs = spark.createDataFrame([(1, words[0] + " tail"), (2, "clean"), (3, words[5])], "doc_id long, text string")
    made, real = [], decontaminate._passes
    monkeypatch.setattr(decontaminate, "_passes", lambda *a: made.append(real(*a)) or made[-1])
    kept = decontaminate.decontaminated(docs, bench, pass_text=400, block_text=200)
    assert [r["doc_id"] for r in kept.collect()] == [2]
    assert len(made) == 1 and len(made[0].groups) > 1  # packed once, in several passes
    assert all(isinstance(n, int) for group in made[0].groups for n in group)  # numbers, no texts
