"""Substring deduplication by longest previous factors: later copies go, the first stays.

For a suffix that starts in a document, its longest previous factor is the
longest prefix that also starts in a document with a smaller id. In suffix
order the best candidates are the nearest suffixes before and after it that
belong to smaller documents. Here factors are cut at the wanted length: within
a run of suffixes that agree on that many bytes, a suffix has such a factor
if a smaller document stands before it (the prefix minimum of ids is smaller)
or after it (the suffix minimum is).

No task sees the whole text. A string is sent to a shard by its least hash of
24 bytes inside, its anchor; equal strings have equal anchors. Anchors that
occur in one document only are dropped first. Neighbouring strings with the
same anchor travel as one segment, equal segments of a block as one with the
smallest id, and a shard sorts the suffixes of segments whose anchor has
several different ones. Blocks of suffixes never grow with a group of copies.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w

ANCHOR = 24     # bytes of an anchor, at most half of the wanted length is better for short strings
HOT = 1000      # occurrences from which an anchor's strings are dealt out one by one
LONGEST = 32    # starts in a segment, one bit each in an answer
NO_ID = np.iinfo(np.int64).max  # rows without an id come last
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
WITH_SPANS = RESULT + ", removed array<struct<start:long,stop:long>>"


def _grams(seg: np.ndarray, n: int) -> np.ndarray:
    sums = np.zeros(len(seg) + 1, np.uint64)
    np.cumsum(w._VALUES[seg] * w.powers(len(seg)), out=sums[1:])
    return w.mix((sums[n:] - sums[:-n]) * w.powers(len(seg), -1)[:len(seg) - n + 1])


def segments(data: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Starts, counts and anchors of the segments: neighbouring starts of whole strings with one anchor, cut at LONGEST."""
    gram = min(ANCHOR, length)
    ends = np.repeat(at[1:], np.diff(at)) if len(data) < w.PIECE else None
    for a in range(0, len(data) - length + 1, w.PIECE):
        seg = data[a:a + w.PIECE + length - 1]
        n = len(seg) - length + 1
        values = _grams(seg, gram)
        place = w.least_places(values, length - gram + 1)[:n]
        doc = np.searchsorted(at, np.arange(a, a + n, dtype=np.int64), "right") - 1 if ends is None else None
        stop = at[doc + 1] if ends is None else ends[a:a + n]
        ok = np.arange(a + length, a + length + n) <= stop
        starts = np.flatnonzero(ok)
        if not len(starts):
            continue
        place = place[starts]
        new = np.append(True, (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1))
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(starts)))
        if sizes.max() > LONGEST:
            times = -(-sizes // LONGEST)
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            heads, left = np.repeat(heads, times) + part * LONGEST, np.repeat(sizes, times) - part * LONGEST
            sizes = np.minimum(left, LONGEST)
        yield starts[heads] + a, sizes, w.mix(values[place[heads]])


def _segments(data, at, length):
    parts = list(segments(data, at, length))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _ids(rows: pa.Table) -> np.ndarray:
    return rows.column("id").cast(pa.int64()).fill_null(NO_ID).to_numpy()


def _codes(anchors: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct anchors, each with 1 if it stands in one document here, else how often it stands (2 to 255)."""
    distinct, number, counts = np.unique(anchors, return_inverse=True, return_counts=True)
    low, high = np.full(len(distinct), NO_ID), np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, number, ids)
    np.maximum.at(high, number, ids)
    return distinct, np.where(low < high, np.minimum(counts, 255), 1).astype(np.uint8)


def _rate(payloads, often: int):
    """For each anchor asked about: 0 if one document has it, 1 if several have, 2 if it is hot."""
    got = [b.arrays_in(p) for p in payloads]
    keys = np.concatenate([b.widen(x, y) for x, y, _ in got])
    number = np.unique(keys, return_inverse=True)[1]
    total = np.bincount(number, np.concatenate([c for _, _, c in got]))[number]
    rates = (total > 1).astype(np.uint8) + (total > often)
    return [r.astype(np.uint8).tobytes() for r in np.split(rates, np.cumsum([len(x) for x, _, _ in got])[:-1])]


def _surviving(rows: pa.Table, length: int, payloads: list):
    """Segments whose anchor stands in several documents, their ids, and numbers that equal ones share.

    Strings with a hot anchor are segments of their own, and their own hash takes the anchor's place: what differs around
    a common line or passage is dealt to many shards.
    """
    data, at = w.buffer(rows.column("text"))
    starts, sizes, anchors = _segments(data, at, length)
    distinct, number = np.unique(anchors, return_inverse=True)
    rate = np.concatenate([np.frombuffer(p.as_buffer(), np.uint8) for p in payloads])[number] if len(distinct) else np.zeros(0, np.uint8)
    hot = rate > 1
    which = np.repeat(np.flatnonzero(hot), sizes[hot])
    offset = np.arange(len(which)) - np.repeat(np.cumsum(sizes[hot]) - sizes[hot], sizes[hot])
    starts, sizes, anchors, single = (np.concatenate(x) for x in (
        (starts[rate == 1], starts[which] + offset), (sizes[rate == 1], np.ones(len(which), np.int64)),
        (anchors[rate == 1], np.zeros(len(which), np.uint64)), (np.zeros((rate == 1).sum(), bool), np.ones(len(which), bool))))
    order = np.argsort(starts, kind="stable")
    starts, sizes, anchors, single = starts[order], sizes[order], anchors[order], single[order]
    prints = _prints(data, starts, sizes + length - 1)
    anchors[single] = w.mix(prints[single])
    ids = _ids(rows)[np.searchsorted(at, starts, "right") - 1]
    order, first = _alike(anchors, prints, ids)
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(first) - 1
    return data, at, starts, sizes, anchors, ids, group, order[first]


def _alike(anchors, prints, ids) -> tuple[np.ndarray, np.ndarray]:
    """Order by anchor, bytes and id, and where in it another anchor or other bytes begin."""
    order = np.lexsort((ids, prints, anchors))
    first = np.ones(len(order), bool)
    first[1:] = (anchors[order][1:] != anchors[order][:-1]) | (prints[order][1:] != prints[order][:-1])
    return order, first


def _prints(data: np.ndarray, starts: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte runs that overlap little, piece by piece."""
    out = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data), w.PIECE)).tolist() + [len(starts)]
    for i, j in zip(cuts, cuts[1:]):
        if i == j:
            continue
        a, z = int(starts[i]), int((starts[i:j] + spans[i:j]).max())
        sums = np.zeros(z - a + 1, np.uint64)
        np.cumsum(w._VALUES[data[a:z]] * w.powers(z - a), out=sums[1:])
        s, e = starts[i:j] - a, starts[i:j] + spans[i:j] - a
        out[i:j] = w.mix((sums[e] - sums[s]) * w.powers(z - a, -1)[s] + (e - s).astype(np.uint64))
    return out


def _gather(data: np.ndarray, starts: np.ndarray, spans: np.ndarray) -> np.ndarray:
    firsts = np.cumsum(spans) - spans
    return data[np.repeat(starts - firsts, spans) + np.arange(int(spans.sum()))]


def previous_factors(text: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes have ``length`` bytes in common with one of a smaller owner: sort, then minima before and after in each run."""
    columns = []
    for k in range(0, length, 8):
        n = min(8, length - k)
        raw = np.zeros((len(starts), 8), np.uint8)
        raw[:, :n] = text[starts[:, None] + np.arange(k, k + n)]
        columns.append(raw.view(">u8").ravel().astype(np.uint64))
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        ranked = c[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    run = np.cumsum(new) - 1
    owner = owners[order]
    # Minima up to and from each place in its run: ranks of owners fall from run to run, so that one pass serves all runs.
    rank = np.unique(owner, return_inverse=True)[1].astype(np.int64)
    span = int(rank.max(initial=0)) + 1
    before = np.minimum.accumulate(rank - run * span) + run * span
    after = (np.minimum.accumulate((rank + run * span)[::-1]) - (run * span)[::-1])[::-1]
    out = np.empty(len(order), bool)
    out[order] = (before < rank) | (after < rank)
    return out


def _compare(length: int):
    def reply(_, payloads):
        got = [b.arrays_in(b.unsqueezed(p)) for p in payloads]
        anchors, ids, sizes, text = (np.concatenate([g[k] for g in got]) for k in range(4))
        sizes = sizes.astype(np.int64)
        spans = sizes + length - 1
        starts = np.cumsum(spans) - spans
        prints = _prints(text, starts, spans)
        order, kind = _alike(anchors, prints, ids)
        number = np.cumsum(kind) - 1
        head = order[kind]
        # A copy of a segment that starts in a smaller document goes whole; only the first is compared with other segments.
        gone = np.zeros(len(order), np.uint32)
        whole = (np.uint64(1) << sizes.astype(np.uint64)).astype(np.uint64) - np.uint64(1)
        later = ids[order] > ids[head][number]
        gone[order[later]] = whole[order[later]].astype(np.uint32)
        lead = anchors[head]
        shared = np.zeros(len(head), bool)
        same = lead[1:] == lead[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        some = head[shared]
        n = sizes[some]
        which = np.repeat(np.arange(len(some)), n)
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        has = previous_factors(text, starts[some][which] + offset, ids[some][which], length)
        bits = np.zeros(len(some), np.uint32)
        np.bitwise_or.at(bits, which[has], (np.uint32(1) << offset[has].astype(np.uint32)))
        of_head = np.zeros(len(head), np.uint32)
        of_head[shared] = bits
        gone[order] |= of_head[number]
        return [g.tobytes() for g in np.split(gone, np.cumsum([len(g[0]) for g in got])[:-1])]
    return reply


def earlier_copies_removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, spans: bool = False,
                           hot: int = HOT, block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """One row per document: its bytes, how many are covered by a string of ``length`` bytes that also starts in a document with a smaller id, their
    maximal runs, and a digest of the rest (with ``spans``: the runs). Judged on the input, so what goes does not depend on the order of work.

    Null counts as the empty text; shorter texts than ``length`` lose nothing; rows that repeat an id are one document to each
    other (neither is earlier); rows without an id are later than all others; other columns are ignored; an empty table
    gives no rows. Runs may begin or end within a character. ``hot``
    and ``block_bytes`` change how the work is dealt, not the result. A text of any length is worked on whole, as a block of its own.
    """
    scratch = b.Scratch(docs.sparkSession, "factors")
    packed = b.pack(scratch, docs, id_col, text_col, size=block_bytes)
    shards = b.shards_for(packed)

    def ask_anchors(block, rows):
        data, at = w.buffer(rows.column("text"))
        starts, _, anchors = _segments(data, at, length)
        distinct, codes = _codes(anchors, _ids(rows)[np.searchsorted(at, starts, "right") - 1])
        return b.requests(block, distinct, shards, lambda s: b.narrow_with(distinct[s], codes[s]))
    rates = scratch.save(b.answer(b.ask(packed, ask_anchors), lambda _, payloads: _rate(payloads, hot)), "rates")

    def ask_segments(block, rows, payloads):
        data, _, starts, sizes, anchors, ids, _, head = _surviving(rows, length, payloads[0])
        a, i, n, s = anchors[head], ids[head], sizes[head], starts[head]
        return b.requests(block, a, shards, lambda k: b.squeezed(
            b.arrays_out(a[k], i[k], n[k].astype(np.uint8), _gather(data, s[k], n[k] + length - 1))))
    answers = scratch.save(b.answer(b.ask_told(packed, [rates], ask_segments), _compare(length)), "answers")

    def use(block, rows, payloads):
        data, at, starts, sizes, _, ids, group, head = _surviving(rows, length, payloads[0])
        removed = np.zeros(len(data), bool)
        if len(head):
            gone = np.concatenate([np.frombuffer(p.as_buffer(), np.uint32) for p in payloads[1]])
            full = ((np.uint64(1) << sizes.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
            bits = np.where(ids > ids[head][group], full, gone[group])
            some = np.flatnonzero(bits)
            which, offset = np.nonzero(bits[some, None] >> np.arange(LONGEST, dtype=np.uint32) & np.uint32(1))
            removed = w.covered(starts[some][which] + offset, length, len(data))
        return _result(rows, data, at, removed, spans)
    return b.told(packed, [rates, answers], use, WITH_SPANS if spans else RESULT)


def _result(rows: pa.Table, data, at, removed: np.ndarray, with_spans: bool) -> pa.Table:
    kept = data[~removed].tobytes()
    upto = np.concatenate(([0], np.cumsum(removed)))[at]
    left = at - upto
    begins = removed.copy()
    begins[1:] &= ~removed[:-1]
    edge = at[at < len(data)]
    begins[edge] = removed[edge]
    n_spans = np.diff(np.concatenate(([0], np.cumsum(begins)))[at])
    digests = [hashlib.sha256(kept[a:z]).hexdigest() for a, z in zip(left.tolist(), left[1:].tolist())]
    out = {"doc_id": rows.column("id").cast(pa.int64()), "n_bytes": np.diff(at), "n_removed": np.diff(upto), "n_spans": n_spans.astype(np.int64),
           "kept_sha256": pa.array(digests, pa.string())}
    if with_spans:
        runs = [w.runs(removed[a:z]) for a, z in zip(at, at[1:])]
        out["removed"] = pa.array([[{"start": s, "stop": e} for s, e in zip(*(x.tolist() for x in r))] for r in runs],
                                  pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
    return pa.table(out)
