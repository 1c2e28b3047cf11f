"""Every operator on awkward rows, against brute force, with clashing columns, and on an empty table."""
import math

import pytest

from ledgerloom.llm import chosen_path, decontaminate, fair_mix, fuse_dedup, line_templates, lpf_dedup, ngram_lm, quality, token_counts, window_dedup
from tests.llm import brute

ITEMS = [(1, " ".join(f"shared{k}" for k in range(10, 30))), (2, "ONE"), (3, None), (4, "..."), (None, "naïve 日本"), (5, "b, c; d"), (5, "negative id")]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def pairs(rows):
    return [r[:2] for r in rows]


def test_exact(frame, awkward, sure):
    assert sure(fuse_dedup.exact_dedup(frame(awkward)).collect()) == sure(brute.exact(pairs(awkward)))


@pytest.mark.parametrize("options", [{}, {"least": 9}, {"block_bytes": 1000}])
def test_windows(frame, awkward, sure, options):
    assert sure(window_dedup.repeated_windows(frame(awkward), **options).collect()) == sure(brute.substrings(pairs(awkward)))


def test_windows_with_text(frame, awkward):
    rows = window_dedup.repeated_windows(frame(awkward), with_text=True).collect()
    assert all(brute.sha(r["kept_text"]) == r["kept_sha256"] for r in rows)
    assert all(sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_near(frame, awkward, sure, percent):
    got = chosen_path.near_duplicates(frame(awkward), percent=percent, block_bytes=5000).collect()
    assert sure(got) == sure(brute.near(pairs(awkward), percent))


def test_one_of_each(frame, awkward):
    docs = frame(awkward)
    out = chosen_path.one_of_each(docs)
    assert out.schema.names == docs.schema.names
    want = brute.near(pairs(awkward), 80)
    groups = {("set", c) for _, n, c, _ in want if n} | {("empty", i) for i, n, _, _ in want if not n}
    assert out.count() == len(groups)
    assert {(r["doc_id"], r["source"]) for r in out.collect()} <= {(i, s) for i, _, s in awkward}


@pytest.mark.parametrize("options", [{}, {"pass_text": 60, "block_text": 50}])
def test_contamination(frame, awkward, sure, bench, options):
    got = decontaminate.overlaps(frame(awkward), bench, **options).drop("items").collect()
    want = brute.contamination(pairs(awkward), ITEMS)
    assert sure(got) == sure(want)
    kept = decontaminate.decontaminated(frame(awkward), bench, **options)
    assert kept.columns == frame(awkward).columns
    assert sure((r["doc_id"],) for r in kept.collect()) == sure((w[0],) for w in want if not w[5])


@pytest.mark.parametrize("options", [{}, {"pass_text": 60, "block_text": 50}])
def test_rows_of_one_id_are_judged_alone(spark, bench, options):
    passage = " ".join(f"shared{k}" for k in range(10, 30))
    docs = spark.createDataFrame([(1, passage, 7), (1, "clean twin", 8), (2, "clean", 9), (None, passage, 1), (None, "clean", 2)], "doc_id long, text string, _row int")
    kept = decontaminate.decontaminated(docs, bench, **options)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"], r["_row"]) for r in kept.collect()) == [("1", "clean twin", 8), ("2", "clean", 9), ("None", "clean", 2)]


def alternating(n, one="a", other="b"):
    """A pattern of Thue and Morse; with its complement it makes equal polynomials modulo a power of two."""
    return "".join(one if bin(k).count("1") % 2 == 0 else other for k in range(n))


@pytest.mark.parametrize("n", [64, 1024, 2048])
def test_alternating_words_stay_apart(frame, sure, n):
    head, x, y = " ".join(f"w{k}" for k in range(34)), alternating(n), alternating(n, "b", "a")
    rows = [(1, f"{head} {x}", "a"), (2, f"{head} {y}", "a"), (3, x, "b"), (4, y, "b")]
    assert sure(window_dedup.repeated_windows(frame(rows)).collect()) == sure(brute.substrings(pairs(rows)))
    assert sure(chosen_path.near_duplicates(frame(rows), percent=85).collect()) == sure(brute.near(pairs(rows), 85))


def test_no_benchmark(frame, awkward, bench):
    assert decontaminate.overlaps(frame(awkward), bench.limit(0)).filter("contaminated or n_items > 0").count() == 0


@pytest.mark.parametrize("options", [{}, {"hot": 2, "block_bytes": 3000}])
def test_earlier(frame, awkward, sure, options):
    assert sure(lpf_dedup.earlier_copies_removed(frame(awkward), **options).collect()) == sure(brute.earlier(pairs(awkward)))


def test_earlier_spans(frame, awkward):
    rows = lpf_dedup.earlier_copies_removed(frame(awkward), spans=True).collect()
    assert all(len(r["removed"]) == r["n_spans"] and sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in rows)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 2000}])
def test_scores(frame, awkward, sure, options):
    got = sure((tuple(r) for r in ngram_lm.scored(frame(awkward), **options).collect()), 4)
    want = sure(brute.scores(pairs(awkward)), 4)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-6, abs_tol=1e-3) and abs(g[6] - w[6]) < 3e-4 * g[2] + 1e-3


def test_mix(frame, awkward):
    got = fair_mix.mix(frame(awkward)).collect()
    sized, size, target = brute.mix(awkward)
    assert sorted((r["size"], r["source_size"], round(r["target"], 6)) for r in got) == sorted((z, size[s], round(target[s], 6)) for _, s, z, _ in sized)
    assert all(r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"] for r in got)
    assert sum(r["taken"] for r in got) <= sum(size.values())


def test_lines_keep_rows(frame, awkward, sure):
    docs = frame(awkward)
    out = line_templates.drop_recurring(docs)
    assert out.schema.names == docs.schema.names
    assert sure((r["doc_id"], r["text"], r["source"]) for r in out.collect()) == sure(awkward)  # nothing recurs often enough here


def test_quality(spark, frame, awkward):
    labels = spark.createDataFrame([(i, (i or 0) % 2) for i, _, _ in awkward] + [(4, None), (999, 1)], "doc_id long, quality int")
    rows = quality.scored(frame(awkward), labels).collect()
    assert len(rows) == len(awkward) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == brute.held(r["doc_id"], 5) for r in rows)
    assert all(r["score"] == 0.5 for r in quality.scored(frame(awkward), labels.limit(0)).collect())


def test_tokens(frame, awkward):
    known = token_counts.of_scores({"▁": -3.0, "▁o": -2.0, "ne": -2.0, "n": -4.0, "e": -4.0, "a": -1.0, "b": -1.0, "ab": -1.5, "x": -1.0})
    rows = token_counts.token_counts(frame(awkward), vocabulary=known).collect()
    got = {(r["doc_id"], r["n_words"]): r["n_tokens"] for r in rows}
    assert got[1, 0] == got[2, 0] == got[3, 0] == 0 and got[4, 1] == 2 and got[6, 4] == 4 * 2 and got[17, 1] == 5001 and got[19, 1] == 70_001
    assert len(rows) == len(awkward)


@pytest.mark.parametrize("run", [
    fuse_dedup.exact_dedup, window_dedup.repeated_windows, chosen_path.near_duplicates, chosen_path.one_of_each, lpf_dedup.earlier_copies_removed,
    ngram_lm.scored, fair_mix.mix, line_templates.report, line_templates.drop_recurring,
    lambda d: token_counts.token_counts(d, vocabulary=token_counts.of_scores({"a": 0.0})),
    lambda d: decontaminate.overlaps(d, d.select(d.doc_id.alias("item_id"), "text")), lambda d: quality.scored(d, d.selectExpr("doc_id", "1 as quality"))])
def test_empty_table(frame, run):
    assert run(frame([])).collect() == []


def test_only_null_texts(frame):
    rows = [(1, None, None), (None, None, "s")]
    docs = frame(rows)
    assert all(r["n_removed"] == 0 for r in window_dedup.repeated_windows(docs).collect())
    assert all(r["n_removed"] == 0 for r in lpf_dedup.earlier_copies_removed(docs).collect())
    assert {(r["doc_id"], r["component_id"]) for r in chosen_path.near_duplicates(docs).collect()} == {(1, 1), (None, None)}
    assert all(r["taken"] == 0 and r["target"] == 0 for r in fair_mix.mix(docs).collect())
    assert [r["n_tokens"] for r in ngram_lm.scored(docs).collect()] == [1, 1]
    assert chosen_path.one_of_each(docs).count() == 2 and line_templates.drop_recurring(docs).count() == 2
