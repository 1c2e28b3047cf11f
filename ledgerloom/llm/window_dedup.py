"""Substring deduplication: remove words in windows that occur again anywhere.

Level-wise doubling. A window of the full length can only be repeated if the
shorter windows inside it are. Each level looks at windows of one length, the
next level at windows of twice that length (the last one at the full length),
and only where the level before found repeats; it ends when no candidates
survive or the full length is reached. On a level below the last, one window
stands for each full window: the one with the least hash among those inside.
Equal full windows choose equal representatives, so nothing is missed, and a
level asks about some 6 % (short) to 10 % of the positions only.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w

SECOND = np.uint64(0x5851F42D4C957F2D)
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
WITH_TEXT = RESULT + ", kept_text string, removed array<struct<start:long,stop:long>>"


def levels(length: int, least: int) -> list[int]:
    """Window lengths, each at most twice the one before; the last is the full length."""
    out = [length]
    while (out[0] + 1) // 2 >= least:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _representatives(found: w.Words, size: int, length: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows that stand for the full windows at ``starts``, once for each place, and each start's number among them."""
    short = w.windows(found.hash, size)
    place = w.least_places(short, length - size + 1)[starts]
    new = np.append(True, place[1:] != place[:-1])[:len(place)]
    return w.mix(short[place[new]]), np.cumsum(new) - 1  # least hashes are small: mixed again, they spread over the shards


def _screen(found: w.Words, sizes: list[int], length: int, shards: int, payloads: list[list]) -> np.ndarray:
    """Starts of full windows that survive the levels answered so far."""
    starts = np.flatnonzero(w.whole(found.first, length))
    for size, answers in zip(sizes, payloads):
        values, number = _representatives(found, size, length, starts)
        asked, where = np.unique(values, return_inverse=True)
        starts = starts[b.flags_back(asked, shards, answers)[where][number]]
    return starts


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, least: int = 16,
                     with_text: bool = False, block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """One row per document: its words, how many lie in a repeated window, and the rest.

    A window is ``length`` consecutive words (``[^\\x20\\x09-\\x0D]+``, unchanged) of one document; it is repeated if the
    same words start anywhere else, in the same document too. All words of repeated windows go, judged on the input. The
    kept words are joined by one space (``kept_sha256``, and ``kept_text`` with ``with_text``, which also gives the removed
    runs of words). ``least`` is the length below which no level starts.

    A null text has no words; texts shorter than a window lose nothing; repeated rows count as documents of their own, so
    both lose their windows; ids may be null or repeated and come back as they are; other columns are ignored; an empty
    table gives no rows. A text of any length is worked on whole, as a block of its own.
    """
    spark, sizes = docs.sparkSession, levels(length, least)
    scratch = b.Scratch(spark, "windows")
    packed = b.pack(scratch, docs, id_col, text_col, size=block_bytes)
    shards = b.shards_for(packed)
    answers: list[DataFrame] = []
    for k, size in enumerate(sizes[:-1]):
        def ask_level(block, rows, payloads, done=sizes[:k], size=size):
            found = w.find(*w.buffer(rows.column("text")))
            starts = _screen(found, done, length, shards, payloads)
            distinct, counts = np.unique(_representatives(found, size, length, starts)[0], return_counts=True)
            return b.requests(block, distinct, shards, lambda s: b.narrow(distinct[s], counts[s] > 1))
        answers.append(scratch.save(b.repeated(b.ask_told(packed, answers, ask_level)), f"level{k}"))

    def ask_full(block, rows, payloads):
        found = w.find(*w.buffer(rows.column("text")))
        one, two, again, _ = _full(found, _screen(found, sizes[:-1], length, shards, payloads), length)
        return b.requests(block, one, shards, lambda s: b.arrays_out(one[s], two[s], np.packbits(again[s])))
    answers.append(scratch.save(_compare(b.ask_told(packed, answers, ask_full)), "full"))

    def use(block, rows, payloads):
        data, at = w.buffer(rows.column("text"))
        found = w.find(data, at)
        starts = _screen(found, sizes[:-1], length, shards, payloads)
        one, _, _, where = _full(found, starts, length)
        gone = w.covered(starts[b.flags_back(one, shards, payloads[-1])[where]], length, len(found.hash))
        return _result(rows, data, at, found, gone, with_text)
    return b.told(packed, answers, use, WITH_TEXT if with_text else RESULT)


def _full(found: w.Words, starts: np.ndarray, length: int):
    """Distinct surviving windows by two hashes (sorted), which occur twice here, and each start's number."""
    one = w.windows(found.hash, length)[starts]
    two = (w.windows(w.mix(found.hash ^ SECOND), length)[starts] >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((two, one))
    first = np.append(True, (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])) if len(order) else np.zeros(0, bool)
    number = np.cumsum(first) - 1
    where = np.empty(len(order), np.int64)
    where[order] = number
    kept = order[first]
    return one[kept], two[kept], np.bincount(number, minlength=len(kept)) > 1, where


def _compare(asked: DataFrame) -> DataFrame:
    def reply(_, payloads):
        got = [b.arrays_in(p) for p in payloads]
        one, two = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
        flags = np.concatenate([np.unpackbits(g[2], count=len(g[0])) for g in got]).astype(bool)
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        flags[order[1:][same]] = True
        flags[order[:-1][same]] = True
        return [np.packbits(f).tobytes() for f in np.split(flags, np.cumsum([len(g[0]) for g in got])[:-1])]
    return b.answer(asked, reply)


def _result(rows: pa.Table, data, at, found: w.Words, gone: np.ndarray, with_text: bool) -> pa.Table:
    raw, n_words = data.tobytes(), np.diff(found.first)
    upto = np.concatenate(([0], np.cumsum(gone)))
    n_removed = upto[found.first[1:]] - upto[found.first[:-1]]
    digests, texts, spans = [], [], []
    for i, (a, z, dropped) in enumerate(zip(found.first[:-1].tolist(), found.first[1:].tolist(), n_removed.tolist())):
        parts = raw[at[i]:at[i + 1]].split()
        if dropped:
            parts = [p for p, g in zip(parts, gone[a:z].tolist()) if not g]
        kept = b" ".join(parts)
        digests.append(hashlib.sha256(kept).hexdigest())
        if with_text:
            texts.append(kept)
            spans.append([{"start": s, "stop": e} for s, e in zip(*(x.tolist() for x in w.runs(gone[a:z])))])
    out = {"doc_id": rows.column("id").cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
           "kept_sha256": pa.array(digests, pa.string())}
    if with_text:
        out["kept_text"] = pa.array(texts, pa.binary()).cast(pa.string())
        out["removed"] = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
    return pa.table(out)
