"""Cross-tokenizer alignment: against whole texts encoded one by one, on awkward rows, and its parts."""
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import token_alignment as t
from ledgerloom.llm.queries import QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
HARD = [
    (40, " leading"), (41, "trailing "), (42, "two  spaces   three"), (43, "tab\tand\nline \r\n  x"), (44, "it's we'll I'M 'quoted'"), (45, "▁ piece mark"),
    (46, "no▁space"), (47, "<|endoftext|> <s> <0x0A> </s> <unk>"), (48, "日本語 テキスト 🙂🙂 é ́x"), (49, "\x00 \x1f a \x85 b  c 　d"),
    (50, " "), (51, "   "), (52, "1234567890 12,345.67 a_b c-d"), (53, "x" * 3000), (54, "αβγ δεζ " * 40), (55, "a ​ b ﻿ c"), (56, "#$%&*| ##  %%"),
    (57, "٣٤ ²x ½ y"), (58, "a b"), (59, "Ünïcödé ŵörds ånd straße " * 3),
]


@pytest.fixture(scope="module")
def vocabularies():
    return [t.Vocabulary(k(open(p, "rb").read())) for k, p in ((t.ByteLevel, t.BYTE_BPE), (t.Pieces, t.PIECES))]


def want(rows):
    return brute.alignment(rows, t.BYTE_BPE, t.PIECES)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 1000}])
def test_awkward(frame, awkward, sure, options):
    rows = [*awkward, *((i, x, None) for i, x in HARD)]
    got = [tuple(r) for r in t.alignment(frame(rows), **options).collect()]
    assert sure(got) == sure(want([r[:2] for r in rows]))
    assert all(r[7] == "" and not any(r[1:7]) for r in got if r[0] in (1, 2, 45, 46))


def test_query(spark, sure):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert sure(tuple(r) for r in QUERIES["op11_token_alignment"](spark, FOLDER).collect()) == sure(want(rows))


def test_groups_and_link_counts(spark):
    docs = spark.createDataFrame([*HARD, (60, "leading"), (61, None)], "doc_id long, text string")
    rows = t.alignment(docs, with_groups=True).collect()
    assert all(r["groups_sha256"] == (brute.sha(r["groups"]) if r["groups"] else "") for r in rows)
    links = t.link_counts(docs).collect()
    holders = {}
    for r in rows:
        pairs = {(int(p), int(q)) for g in filter(None, r["groups"].split(";")) for p in g.split("|")[0].split(",") for q in g.split("|")[1].split(",")}
        for pair in pairs:
            holders[pair] = holders.get(pair, 0) + 1
    assert {(x["a_id"], x["b_id"]): x["documents"] for x in links} == holders
    assert all(x["best"] == (x["documents"] == max(n for (p, _), n in holders.items() if p == x["a_id"])) for x in links)


def test_nothing(frame):
    assert t.alignment(frame([])).collect() == [] and t.link_counts(frame([])).collect() == []
    assert [tuple(r) for r in t.alignment(frame([(None, None, "s")])).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(" ab'\t\n.é1▁", max_size=40)), max_size=6))
def test_chunks_are_as_whole_texts(vocabularies, texts):
    got = t.align_texts(texts, *vocabularies)
    rows = brute.alignment(list(enumerate(texts)), t.BYTE_BPE, t.PIECES)
    assert [tuple(c) for c in got.counts.tolist()] == [r[1:5] for r in rows]
    assert [brute.sha(g) if g else "" for g in got.groups] == [r[7] for r in rows]


@given(st.lists(st.integers(1, 4), max_size=30), st.lists(st.integers(1, 4), max_size=30))
def test_coalesced(a, b):
    n = min(sum(a), sum(b))

    def tiled(sizes):
        ends = [e for e in np.cumsum(sizes).tolist() if e < n] + [n] if n else []
        return [0, *ends[:-1]][:len(ends)], ends
    (sa, ea), (sb, eb) = tiled(a), tiled(b)
    start, end, kind = np.array(sa + sb, int), np.array(ea + eb, int), np.array([0] * len(sa) + [1] * len(sb))
    order, group = t.coalesced(start, end, kind)
    cuts = sorted(set(ea) & set(eb))
    assert group.tolist() == [sum(c <= s for c in cuts) for s in start[order]]


@pytest.mark.parametrize("step, call", [(1, 1), (3, 20), (1 << 15, 50)])
def test_steps_and_calls_change_nothing(vocabularies, monkeypatch, step, call):
    texts = [x for _, x in HARD] * 2 + [None, "a b c d e f g", "a b▁ c"]
    monkeypatch.setattr(t, "STEP", step)
    monkeypatch.setattr(t, "CALL", call)
    got = t.align_texts(texts, *vocabularies)
    rows = want(list(enumerate(texts)))
    assert [tuple(c) for c in got.counts.tolist()] == [r[1:5] for r in rows]
    assert [brute.sha(g) if g else "" for g in got.groups] == [r[7] for r in rows]
    assert (got.holders > 0).all()
