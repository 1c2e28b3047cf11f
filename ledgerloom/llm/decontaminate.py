"""Benchmark decontamination with suffix arrays of the training text.

Each shard (some MB of documents) gets a suffix array over its words: the
starts of its suffixes, sorted by the words that follow. Every suffix of every
benchmark item is then binary-searched in it; the range it falls in holds all
its occurrences. Suffixes that begin with fewer words of the benchmark's own
vocabulary than any window needs cannot match and are left out of the array.
Nothing is shuffled: the benchmark goes to the shards, in blocks whose size is
checked.
"""
from __future__ import annotations

import itertools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w

WINDOW = 13
BLOCK_TEXT = 1 << 20   # bytes of benchmark text searched at a time
PASS_TEXT = 32 << 20   # bytes of benchmark text sent to the tasks at once; a longer benchmark takes more passes over the documents
SHARE = 20             # contaminated: this many times the hit words is at least the words
VERDICT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<long>"
MATCH = "doc_id long, item_id long, doc_start long, item_start long, n_words long"
PART = "block long, place long, doc_id long, n_words long, starts array<int>, stops array<int>, items array<long>"


def _find(data, at) -> w.Words:
    return w.find(data, at, w.ALNUM, w.FOLDED)


class Tests(NamedTuple):
    """A block of the benchmark: its vocabulary, its distinct windows, and which items have them where."""
    words: np.ndarray    # sorted hashes of its words
    keys: np.ndarray     # windows as big-endian word numbers, sorted, zero after a short one
    lengths: np.ndarray  # words of each window
    first: np.ndarray    # window -> its places, one entry more than windows
    items: np.ndarray    # item of each place
    starts: np.ndarray   # word of the item at each place
    least: np.ndarray    # word number -> fewest words of a window that begins with it


def tests(items: pa.Array, texts: pa.Array) -> Tests | None:
    found = _find(*w.buffer(texts))
    if not len(found.hash):
        return None
    words, number = np.unique(found.hash, return_inverse=True)
    number = number.astype(np.uint32) + 1
    counts = np.diff(found.first)
    full = np.flatnonzero(w.whole(found.first, WINDOW))
    short = found.first[:-1][(counts > 0) & (counts < WINDOW)]
    starts = np.concatenate([full, short])
    lengths = np.concatenate([np.full(len(full), WINDOW), counts[(counts > 0) & (counts < WINDOW)]])
    keys, place = np.unique(_suffixes(number, starts, lengths), return_inverse=True)
    order = np.argsort(place, kind="stable")
    first = np.searchsorted(place[order], np.arange(len(keys) + 1))
    in_item = found.text[starts]
    least = np.full(len(words) + 1, WINDOW + 1)
    np.minimum.at(least, number[starts], lengths)
    ids = np.array([*items.to_pylist(), None], object)[:-1]  # ids stay whole numbers beside nulls
    return Tests(words, keys, lengths[order][first[:-1]], first, ids[in_item][order], (starts - found.first[in_item])[order], least)


def _suffixes(number: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Up to 13 word numbers from each start, as bytes that sort like the words."""
    reach = np.arange(WINDOW)
    picked = number[np.minimum(starts[:, None] + reach, len(number) - 1)]
    picked[reach >= lengths[:, None]] = 0
    return np.ascontiguousarray(picked.astype(">u4")).view(f"S{WINDOW * 4}").ravel()


def suffix_array(found: w.Words, test: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of the shard's texts and their first words, of those that any window could match."""
    at = np.minimum(np.searchsorted(test.words, found.hash), len(test.words) - 1)
    known = test.words[at] == found.hash
    number = np.where(known, at + 1, 0).astype(np.uint32)
    # Words up to the next one that no test has, or the end of the text.
    ends = np.minimum.accumulate(np.where(known, len(known), np.arange(len(known)))[::-1])[::-1] if len(known) else np.zeros(0, np.int64)
    reach = np.minimum(np.minimum(ends, found.stop) - np.arange(len(known)), WINDOW)
    starts = np.flatnonzero(reach >= test.least[number])
    keys = _suffixes(number, starts, reach[starts])
    order = np.argsort(keys, kind="stable")
    return keys[order], starts[order]


def search(keys: np.ndarray, test: Tests) -> tuple[np.ndarray, np.ndarray]:
    """For each window, the range of the suffix array that begins with it."""
    after = test.keys.copy().view(np.uint8).reshape(-1, WINDOW * 4)
    after[np.arange(WINDOW * 4) >= (test.lengths * 4)[:, None]] = 0xFF
    return np.searchsorted(keys, test.keys, "left"), np.searchsorted(keys, after.view(f"S{WINDOW * 4}").ravel(), "right")


def occurrences(found: w.Words, test: Tests) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a window and a word of the shard at which it occurs."""
    keys, starts = suffix_array(found, test)
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, high = search(keys, test)
    return np.repeat(np.arange(len(low)), high - low), starts[_ranges(low, high)]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    sizes = high - low
    return np.repeat(low - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


def _overlap(texts: pa.Array, all_tests: list[Tests]):
    """Words, which of them are hit, and for each text the ids of the items that occur."""
    found = _find(*w.buffer(texts))
    hit, pairs = np.zeros(len(found.hash), bool), []
    for test in all_tests:
        window, start = occurrences(found, test)
        for length in np.unique(test.lengths[window]).tolist():
            hit |= w.covered(start[test.lengths[window] == length], length, len(hit))
        seen = np.unique(np.stack([found.text[start], window]), axis=1) if len(window) else np.zeros((2, 0), np.int64)
        places = _ranges(test.first[seen[1]], test.first[seen[1] + 1])
        docs = np.repeat(seen[0], test.first[seen[1] + 1] - test.first[seen[1]])
        pairs += zip(docs.tolist(), test.items[places].tolist())
    items: list[set] = [set() for _ in range(len(texts))]
    for doc, item in pairs:
        items[doc].add(item)
    return found, hit, items


def _verdicts(ids, n_words, n_hit, items: list[set]) -> pa.Table:
    def digest(some):
        return hashlib.sha256(",".join(sorted("" if i is None else str(int(i)) for i in some)).encode()).hexdigest()
    n_words, n_hit = np.asarray(n_words, np.int64), np.asarray(n_hit, np.int64)
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": n_words, "n_hit": n_hit, "n_items": pa.array([len(i) for i in items], pa.int64()),
                     "items_sha256": pa.array([digest(i) for i in items], pa.string()),
                     "contaminated": pa.array((n_hit > 0) & (SHARE * n_hit >= n_words)),
                     "items": pa.array([sorted(int(i) for i in some if i is not None) for some in items], pa.list_(pa.int64()))})


class Passes(NamedTuple):
    """The benchmark in stored blocks, and the numbers of the blocks that go together, by size."""
    packed: DataFrame
    groups: list[list[int]]


def _passes(benchmark: DataFrame, id_col: str, text_col: str, scratch: b.Scratch, pass_text: int, block_text: int) -> Passes:
    packed = b.pack(scratch, benchmark, id_col, text_col, size=block_text)
    groups, held = [[]], 0
    for row in packed.select("block", "n_bytes").orderBy("block").toLocalIterator():
        if groups[-1] and held + row["n_bytes"] > pass_text:
            groups, held = [*groups, []], 0
        groups[-1].append(row["block"])
        held += row["n_bytes"]
    return Passes(packed, groups)


def _tests_of(packed: DataFrame, group: list[int]) -> list[bytes]:
    """The blocks of one pass, which alone are read by the driver."""
    return [bytes(r["payload"]) for r in packed.filter(F.col("block").isin(group)).select("payload").collect()] if group else []


def _loaded(payloads: list[bytes]) -> list[Tests]:
    out = []
    for payload in payloads:
        rows = b.of_payload(pa.scalar(payload, pa.binary()))
        test = tests(rows.column("id").combine_chunks(), rows.column("text"))
        if test is not None:
            out.append(test)
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", pass_text: int = PASS_TEXT, block_text: int = BLOCK_TEXT) -> DataFrame:
    """One row per document: its words, those hit by a window of an item, and the items.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z. A window is 13 consecutive words of an item, or a
    shorter item's words whole. ``contaminated``: some word is hit and 20 times the hit words is at least the words.

    Null and wordless texts have no words and are never contaminated; an item without words has no window; an item
    without an id counts under the empty name and is not listed; items that repeat an id count once; other columns are
    ignored; repeated documents get a row each; no benchmark rows means no hits; no documents, no rows. Long texts are whole.
    """
    passes = _passes(benchmark, item_col, item_text_col, b.Scratch(docs.sparkSession, "benchmark"), pass_text, block_text)
    return _overlaps(docs, passes, id_col, text_col)


def _overlaps(docs: DataFrame, passes: Passes, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    if len(passes.groups) == 1:
        payloads = spark.sparkContext.broadcast(_tests_of(passes.packed, passes.groups[0]))  # at most pass_text, or one item

        def each(batches: Iterator[pa.RecordBatch]):
            loaded = _loaded(payloads.value)
            for batch in batches:
                for i, j in b.pieces(batch):
                    part = batch.slice(i, j - i)
                    found, hit, items = _overlap(part.column("text"), loaded)
                    upto = np.concatenate(([0], np.cumsum(hit)))
                    yield from _verdicts(part.column("id"), np.diff(found.first), upto[found.first[1:]] - upto[found.first[:-1]], items).to_batches()
        return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(each, VERDICT)
    scratch = b.Scratch(spark, "overlaps")  # the benchmark's blocks are still read
    packed, parts = b.pack(scratch, docs, id_col, text_col), []
    scratch.save(packed.select("block"), "blocks")
    for group in passes.groups:
        payloads = spark.sparkContext.broadcast(_tests_of(passes.packed, group))

        def part(batches, payloads=payloads):
            loaded = _loaded(payloads.value)
            for batch in batches:
                for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                    yield from _partial(block, b.of_payload(payload), loaded).to_batches()
        parts.append(packed.select("block", "payload").mapInArrow(part, PART))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return every.groupBy("block").applyInArrow(_merge, VERDICT)


def _partial(block: int, rows: pa.Table, loaded: list[Tests]) -> pa.Table:
    found, hit, items = _overlap(rows.column("text"), loaded)
    spans = [w.runs(hit[a:z]) for a, z in zip(found.first[:-1], found.first[1:])]
    n = rows.num_rows
    return pa.table({"block": pa.array([block] * n, pa.int64()), "place": pa.array(range(n), pa.int64()), "doc_id": rows.column("id").cast(pa.int64()),
                     "n_words": np.diff(found.first), "starts": pa.array([s[0].tolist() for s in spans], pa.list_(pa.int32())),
                     "stops": pa.array([s[1].tolist() for s in spans], pa.list_(pa.int32())),
                     "items": pa.array([list(i) for i in items], pa.list_(pa.int64()))})


def _merge(key, table):
    """A block's documents with what each pass has found in them."""
    ids, sizes, hits, items = [], [], [], []
    for _, group in itertools.groupby(sorted(table.to_pylist(), key=lambda r: r["place"]), key=lambda r: r["place"]):
        rows = list(group)
        change = np.zeros(rows[0]["n_words"] + 1, np.int64)
        for r in rows:
            np.add.at(change, np.array(r["starts"], np.int64), 1)
            np.add.at(change, np.array(r["stops"], np.int64), -1)
        ids.append(rows[0]["doc_id"])
        sizes.append(rows[0]["n_words"])
        hits.append(int((np.cumsum(change) > 0).sum()))
        items.append({i for r in rows for i in r["items"]})
    return _verdicts(ids, sizes, hits, items)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text") -> DataFrame:
    """Longest verbatim matches of a window or more: document, item, the word each starts at, and its words.

    Windows that go on from one another in both texts are one match. Edge cases as in ``overlaps``.
    """
    spark = docs.sparkSession
    out = None
    passes = _passes(benchmark, item_col, item_text_col, b.Scratch(spark, "benchmark"), BLOCK_TEXT, BLOCK_TEXT)
    for group in passes.groups:
        payloads = spark.sparkContext.broadcast(_tests_of(passes.packed, group))

        def each(batches, payloads=payloads):
            loaded = _loaded(payloads.value)
            for batch in batches:
                for i, j in b.pieces(batch):
                    part = batch.slice(i, j - i)
                    found = _find(*w.buffer(part.column("text")))
                    for test in loaded:
                        yield from _longest(part.column("id"), found, test).to_batches()
        one = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(each, MATCH)
        out = one if out is None else out.unionByName(one)
    return out


def _longest(ids, found: w.Words, test: Tests) -> pa.Table:
    window, start = occurrences(found, test)
    places = _ranges(test.first[window], test.first[window + 1])
    sizes = test.first[window + 1] - test.first[window]
    start, length = np.repeat(start, sizes), np.repeat(test.lengths[window], sizes)
    doc, item, at = found.text[start], test.items[places], test.starts[places]
    place = start - found.first[doc]
    known = np.array([-1 if i is None or i != i else i for i in item.tolist()], np.int64)
    order = np.lexsort((place, place - at, known, doc))
    doc, known, at, place, length = (x[order] for x in (doc, known, at, place, length))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (known[1:] != known[:-1]) | (place[1:] - at[1:] != place[:-1] - at[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[:len(first)] - 1
    return pa.table({"doc_id": ids.take(pa.array(doc[first])).cast(pa.int64()), "item_id": pa.array(known[first], mask=known[first] < 0),
                     "doc_start": place[first], "item_start": at[first], "n_words": place[last] - place[first] + length[first]})


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", pass_text: int = PASS_TEXT, block_text: int = BLOCK_TEXT) -> DataFrame:
    """The documents, all columns, without contaminated ones. Each row is judged by its own text, however many passes the benchmark takes
    and whatever ids repeat; if it takes several, the documents are stored with a number for each row, which the passes report by."""
    spark = docs.sparkSession
    passes = _passes(benchmark, item_col, item_text_col, b.Scratch(spark, "benchmark"), pass_text, block_text)
    if len(passes.groups) > 1:
        row = "_row"
        while row in docs.columns:
            row += "_"
        stored = b.Scratch(spark, "decontaminated").save(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
        bad = _overlaps(stored, passes, row, text_col).filter("contaminated").select(F.col("doc_id").alias("_bad"))
        return stored.alias("d").join(bad.alias("b"), F.col(f"d.{row}") == F.col("b._bad"), "left_anti").drop(row)
    payloads = spark.sparkContext.broadcast(_tests_of(passes.packed, passes.groups[0]))

    def each(batches):
        loaded = _loaded(payloads.value)
        for batch in batches:
            for i, j in b.pieces(batch, text_col):
                part = batch.slice(i, j - i)
                found, hit, items = _overlap(part.column(text_col), loaded)
                upto = np.concatenate(([0], np.cumsum(hit)))
                verdicts = _verdicts([None] * part.num_rows, np.diff(found.first), upto[found.first[1:]] - upto[found.first[:-1]], items)
                yield part.filter(pa.compute.invert(verdicts.column("contaminated").combine_chunks()))
    return docs.mapInArrow(each, docs.schema)
