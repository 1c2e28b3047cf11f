"""The data structures and rules inside the operators."""
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import blocks as b
from ledgerloom.llm import chosen_path, fuse_dedup, line_templates, lpf_dedup, ngram_lm, quality, token_counts, words
from ledgerloom.llm.blocks import Scratch
from ledgerloom.llm.components import components
from ledgerloom.llm.elias_fano import EliasFano
from tests.llm import brute


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 50_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    seed, segment, span, bits = fuse_dedup.build_filter(keys)
    bits = np.frombuffer(bits, np.uint8)
    assert fuse_dedup.maybe_in(keys, seed, segment, span, bits).all()
    others = rng.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)
    assert fuse_dedup.maybe_in(others, seed, segment, span, bits).mean() < 0.01
    assert n < 10_000 or len(bits) < 1.35 * n


@pytest.mark.parametrize("n, top", [(0, 10), (1, 1), (5, 3), (1000, 50), (5000, 10**12), (3000, 4000)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
    packed = EliasFano(*EliasFano.arrays(values))
    assert (packed.access(np.arange(n)) == values).all()
    wanted = np.concatenate([values, rng.integers(0, top * 2, 500).astype(np.uint64)])
    first = {}
    for k, v in enumerate(values.tolist()):
        first.setdefault(v, k)
    assert packed.find(wanted).tolist() == [first.get(v, -1) for v in wanted.tolist()]


def test_words_are_found_in_any_text():
    rng = random.Random(3)
    texts = ["", None, " ", "a", "a b", "\x0bé\x0c日本 x\r\n", *("".join(rng.choice("aB \t\né日") for _ in range(rng.randrange(40))) for _ in range(300))]
    for inside, fold, pattern in ((words.UNBLANK, words.AS_IS, brute.WORD), (words.ALNUM, words.FOLDED, brute.ALNUM)):
        found = words.find(*words.buffer(pa.array(texts)), inside, fold)
        want = [pattern.findall(brute.folded(t) if fold is words.FOLDED else t or "") for t in texts]
        assert np.diff(found.first).tolist() == [len(x) for x in want]
        flat = [x for t in want for x in t]
        assert len(set(flat)) == len(set(found.hash.tolist())) == len(set(zip(flat, found.hash.tolist())))


def test_words_longer_than_a_piece():
    long = "x" * (words.PIECE + 7)
    found = words.find(*words.buffer(pa.array([f"a {long} b", long])))
    assert found.first.tolist() == [0, 3, 4] and found.hash[1] == found.hash[3]


def test_previous_factors():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 4000, dtype=np.uint8)
    starts, owners = np.arange(3900), np.sort(rng.integers(0, 40, 3900))
    got = lpf_dedup.previous_factors(text, starts, owners, 10)
    first = {}
    for s, o in zip(starts.tolist(), owners.tolist()):
        first.setdefault(text[s:s + 10].tobytes(), o)
    assert got.tolist() == [first[text[s:s + 10].tobytes()] < o for s, o in zip(starts.tolist(), owners.tolist())]


def test_confirmed_links():
    rng = random.Random(4)
    sets = [np.array(sorted(rng.sample(range(60), rng.randrange(1, 50))), np.uint64) for _ in range(40)]
    got = chosen_path.confirmed(sets, None, 50)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            n = len(np.intersect1d(a, b))
            assert got[i, j] == (i != j and 100 * n >= 50 * (len(a) + len(b) - n))


def test_isotonic_is_monotone_and_pools():
    got = quality.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 3.0, 1.0, 4.0]), np.array([4.0, 4.0, 4.0, 4.0]))
    assert got["levels"].tolist() == [0.0, 0.5, 0.5, 1.0] and got["edges"].tolist() == [0.1, 0.2, 0.3, 0.4]


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, 3), (7, 9), (9, 9)]
    out = components(Scratch(spark, "chain"), spark.createDataFrame(links, "a long, b long"), "c")
    assert {r["node"]: r["component"] for r in out.collect()} == {**{k: 100 for k in range(100, 141)}, 3: 3, 7: 3, 9: 3}


def test_large_groups_of_near_copies(spark):
    rng = random.Random(5)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for i in range(1500):  # more than a block of full comparisons, and than a small node
        x = list(base)
        for _ in range(rng.randrange(3)):
            x[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(x)))
    rows += [(5000 + i, " ".join(f"u{i}_{k}" for k in range(50)) + " " + " ".join(base[:30])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in chosen_path.near_duplicates(docs, percent=85, block_bytes=200_000).collect()}
    want = {r[0]: r[2] for r in brute_near(rows)}
    assert got == want


def brute_near(rows):
    """As brute.near, but comparing with bit sets."""
    number, sets = {}, []
    for i, t in rows:
        bits = 0
        for s in brute.shingles(t):
            bits |= 1 << number.setdefault(s, len(number))
        sets.append(bits)
    up = list(range(len(rows)))

    def root(a):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a
    for a in range(len(rows)):
        for b in range(a):
            if root(a) != root(b) and 100 * (n := (sets[a] & sets[b]).bit_count()) >= 85 * (sets[a] | sets[b]).bit_count() and n:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return [(i, None, rows[root(k)][0]) for k, (i, _) in enumerate(rows)]


def test_boilerplate_goes_and_copies_stay(spark):
    rows = [(i, f"start {i} of text\nPage {i} of the weekly report\nbody words number {i} are here\nAll rights reserved by us.") for i in range(8)]
    rows += [(100 + i, "the same\nwhole text\nthree lines") for i in range(30)]
    names = "anna bert carl dora emil fred gina hans inge".split()
    rows += [(200 + i, f"{name} writes first{' very' * i}\nfor the user {name} a session was opened again\nand {name} ends") for i, name in enumerate(names)]
    got = {r["doc_id"]: r["text"] for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == got[129] == "the same\nwhole text\nthree lines"
    assert all("weekly" not in got[i] and "rights" not in got[i] for i in range(8))
    assert all("session" not in got[200 + i] and f"{name} writes first" in got[200 + i] for i, name in enumerate(names))  # the name is a variable field


def test_token_counts_equal_a_library():
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    known = token_counts.load()
    library = Tokenizer(Unigram([("<unk>", 0.0), *known.scores.items(), *((f"<0x{i:02X}>", -1e9) for i in range(256))], 0, True))
    rng = random.Random(6)
    some = ["".join(rng.choice(["the", "ation", "x", "é", "ß", "日", "er", "Q", "9", "'"]) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    counter = token_counts.Counter(known)
    counter.add({s.encode() for s in some})
    for s in some:
        n = len(library.encode(token_counts.SPACE + s).tokens)
        assert counter.table[s.encode()] == n == token_counts.count_alone(token_counts.SPACE + s, known)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)
    assert math.isclose(sum(r["score"] for r in rows) / len(rows), sum(r["quality"] for r in rows) / len(rows), abs_tol=0.1)




@pytest.mark.parametrize("top", [1, 50, 1 << 20, 1 << 48, (1 << 64) - 1])
def test_distinct_is_unique(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 7, 5000):
        values = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
        values = np.concatenate([values, values[:n // 2], values[:n // 3] ^ np.uint64(1)])
        got, want = words.distinct(values), np.unique(values, return_inverse=True)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_word_counts_travel_in_few_bytes():
    words = np.arange(1, 5001, dtype=np.uint64) << np.uint64(40)
    sent = [pa.scalar(b.squeezed(b.arrays_out(words[s], np.full(len(words[s]), 3, np.uint32))), pa.binary()) for s in (slice(0, 5000), slice(2500, 5000))]
    replies = ngram_lm._count_words(0, sent)
    assert [len(r) < 1000 for r in replies] == [True, True]
    for r, n in zip(replies, (5000, 2500)):
        counts, alone = ngram_lm._counted(pa.scalar(r, pa.binary()))
        assert counts.dtype == np.uint64 and counts.tolist() == [3] * (n - 2500) + [6] * 2500 and alone.tolist() == [True] * (n - 2500) + [False] * 2500
    assert [int.from_bytes(replies[0][i:i + 8], "big") for i in (0, 8)] == [22500, 5000]
