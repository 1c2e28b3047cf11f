"""Exact deduplication of incoming documents against immutable snapshots.

A snapshot keeps one row per distinct text (its digest, its smallest id, its
count) and, for each bucket of digests, a static binary-fuse filter of some 9
bits per digest. Filters are built once and never changed. An incoming batch
is grouped by digest first; its digests are screened bucket by bucket, and only
positives are joined with the snapshot's exact rows, which finds the copies of
snapshot texts; negatives are copies of each other only. Before a copy counts, its
bytes are compared with those of the document it would be dropped for.
"""
from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w

BLANK = b" \t\n\x0b\x0c\r"
PLACES = 23             # bits of a row number for its place in its block
BUCKET_KEYS = 100_000  # digests for a filter
FILTER = "bucket long, seed long, segment long, span long, bits binary"


def normalised(raw: bytes) -> bytes:
    """Each run of ``[\\x20\\x09-\\x0D]`` as one space."""
    inner = b" ".join(raw.split())
    if not inner:
        return b" " if raw else b""
    return (b" " if raw[0] in BLANK else b"") + inner + (b" " if raw[-1] in BLANK else b"")


# --- the filter -------------------------------------------------------------------------------------------------------


def _slots(keys: np.ndarray, seed: int, segment: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Three slots of each key, in neighbouring segments, and its fingerprint of 8 bits."""
    h = w.mix(keys + np.uint64(seed * 2 + 1) * np.uint64(0x9E3779B97F4A7C15))
    base = (h >> np.uint64(32)) * np.uint64(span) >> np.uint64(32)
    inner = np.uint64(segment - 1)
    one = base + np.uint64(segment)
    slots = np.stack([base, one ^ (h >> np.uint64(18) & inner), (one + np.uint64(segment)) ^ (h & inner)]).astype(np.int64)
    return slots, ((h ^ h >> np.uint64(40)) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, span of first slots, and fingerprints, for distinct keys.

    Each key is peeled at a slot that no other remaining key uses; in reverse order that slot is set so that
    the key's three slots make its fingerprint. If some keys cannot be peeled, another seed is taken.
    """
    n = len(keys)
    segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 2)))
    span = max(1, math.ceil(n * factor / segment) - 2) * segment
    for seed in range(1000):
        slots, prints = _slots(keys, seed, segment, span)
        size = span + 2 * segment
        degree, owners = np.zeros(size, np.int64), np.zeros(size, np.int64)
        number = np.arange(n)
        for row in slots:
            degree += np.bincount(row, minlength=size)
            np.bitwise_xor.at(owners, row, number)
        peeled, left, order = np.zeros(n, bool), n, []
        single = np.flatnonzero(degree == 1)
        while len(single):
            found, first = np.unique(owners[single], return_index=True)
            order.append((found, single[first]))
            left -= len(found)
            peeled[found] = True
            for row in slots:
                np.subtract.at(degree, row[found], 1)
                np.bitwise_xor.at(owners, row[found], found)
            touched = np.unique(slots[:, found])
            single = touched[degree[touched] == 1]
        if left == 0:
            bits = np.zeros(size, np.uint8)
            for found, at in reversed(order):
                a, b, c = (bits[row[found]] for row in slots)
                bits[at] = prints[found] ^ a ^ b ^ c  # the slot itself is still 0
            return seed, segment, span, bits.tobytes()
    raise ValueError("no seed peels these keys; are they distinct?")


def maybe_in(keys: np.ndarray, seed: int, segment: int, span: int, bits: np.ndarray) -> np.ndarray:
    """No key of the filter is missed; about one other key in 256 passes."""
    slots, prints = _slots(keys, seed, segment, span)
    return (bits[slots[0]] ^ bits[slots[1]] ^ bits[slots[2]]) == prints


def _keys(table: pa.Table) -> np.ndarray:
    """The first eight bytes of each digest."""
    column = table.column("digest").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    raw = np.frombuffer(column.buffers()[2], np.uint8)[column.offset * 32:(column.offset + len(column)) * 32] if len(column) else np.zeros(0, np.uint8)
    return raw.reshape(-1, 32)[:, :8].copy().view(np.uint64).ravel()


# --- snapshots and batches ----------------------------------------------------------------------------------------------


class Snapshot(NamedTuple):
    """Stored tables: one row per distinct digest (bucket, digest, id, n), and one filter per bucket."""
    exact: DataFrame
    filters: DataFrame
    buckets: int


def digests(packed: DataFrame) -> DataFrame:
    """Narrow rows: a number for the row (its block and place), its id, and the digest of its normalised text."""
    def each(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                rows = b.of_payload(payload)
                assert rows.num_rows <= 1 << PLACES
                data, at = w.buffer(rows.column("text"))
                raw, at = data.tobytes(), at.tolist()
                found = [hashlib.sha256(normalised(raw[x:y])).digest() for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array([block << PLACES | k for k in range(len(found))], pa.int64()),
                                                  rows.column("id").cast(pa.int64()).combine_chunks(), pa.array(found, pa.binary())], names=["node", "doc_id", "digest"])
    return packed.select("block", "payload").mapInArrow(each, "node long, doc_id long, digest binary")


def grouped(rows: DataFrame, buckets: int) -> DataFrame:
    return (rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
            .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets))))


def take_snapshot(scratch: b.Scratch, rows: DataFrame, name: str) -> Snapshot:
    buckets = max(8, -(-rows.count() // BUCKET_KEYS))
    exact = scratch.save(grouped(rows, buckets), f"{name}-exact")

    def build(key, table):
        keys = np.unique(_keys(table))
        seed, segment, span, bits = build_filter(keys)
        return pa.table({"bucket": [key[0].as_py()], "seed": [seed], "segment": [segment], "span": [span], "bits": pa.array([bits], pa.binary())})
    return Snapshot(exact, scratch.save(exact.select("bucket", "digest").groupBy("bucket").applyInArrow(build, FILTER), f"{name}-filters"), buckets)


def screened(batch: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The batch's digests with ``maybe``: whether the snapshot's filter lets them pass."""
    def screen(key, rows, filters):
        flags = np.zeros(rows.num_rows, bool)
        if filters.num_rows and rows.num_rows:
            f = filters.to_pylist()[0]
            flags = maybe_in(_keys(rows), f["seed"], f["segment"], f["span"], np.frombuffer(f["bits"], np.uint8))
        return pa.table([*rows.columns, pa.array(flags)], names=[*rows.column_names, "maybe"])
    batch = batch.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(snapshot.buckets)))
    return batch.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInArrow(
        screen, "digest binary, doc_id long, n long, before long, bucket long, maybe boolean")


def ingest(scratch: b.Scratch, batch: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """``digest, doc_id, n, before``: each distinct digest of the batch with the id it is kept under, which may be a snapshot's, its count here
    and its count in the snapshots."""
    own = grouped(batch, 1).select("digest", "doc_id", "n", F.lit(0).cast("long").alias("before"))
    for snapshot in snapshots:
        seen = screened(own, snapshot).drop("bucket")
        known = snapshot.exact.select("digest", F.col("doc_id").alias("known"), F.col("n").alias("had"))
        hits = (seen.filter("maybe").join(known, "digest", "left")
                .select("digest", F.coalesce(F.least("known", "doc_id"), "doc_id").alias("doc_id"), "n",
                        (F.col("before") + F.coalesce("had", F.lit(0))).alias("before")))
        own = scratch.save(hits.unionByName(seen.filter(~F.col("maybe")).select("digest", "doc_id", "n", "before")), f"ingested{len(snapshots)}")
    return own


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """One row per document, dropped ones too: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are the same after each run of ``[\\x20\\x09-\\x0D]`` became one space; the smallest id stays.
    The lower half of the range of ids is the snapshot, the upper half (and rows without an id) the incoming batch.

    Null counts as the empty text; an empty table gives no rows; rows without an id lose to any row with one; of rows that
    repeat id and text, one is kept and all are counted; other columns are ignored. Groups of any size are joined on the
    digest, where Spark splits a hot one; long texts are read whole.
    """
    scratch = b.Scratch(docs.sparkSession, "exact")
    packed = b.pack(scratch, docs, id_col, text_col, size=block_bytes)
    rows = scratch.save(digests(packed), "digests")
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = (low + high) // 2 if low is not None else 0
    earlier, later = rows.filter(F.col("doc_id") <= middle), rows.filter(F.col("doc_id").isNull() | (F.col("doc_id") > middle))
    snapshot = take_snapshot(scratch, earlier, "snapshot")
    incoming = ingest(scratch, later, [snapshot])
    # Copies of snapshot texts are those that screening and the exact join found; other groups lie within the snapshot or within the batch.
    alone = snapshot.exact.filter(F.col("n") > 1).join(incoming.filter(F.col("before") > 0), "digest", "left_anti")
    found = incoming.filter(F.col("n") + F.col("before") > 1).unionByName(alone, allowMissingColumns=True)
    several = scratch.save(found.select("digest", F.col("doc_id").alias("found_id"), "before"), "several")
    copied = (earlier.join(several.filter(F.col("before").isNull() | (F.col("before") > 0)), "digest", "left_semi")
              .unionByName(later.join(several.filter(F.col("before").isNotNull()), "digest", "left_semi")))
    copies = scratch.save(_texts(packed, copied), "copies")
    classes = scratch.save(_compared(copies, several.drop("before")), "classes")
    # Rows of one digest whose bytes differ from the first document's are groups of their own.
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))
    groups = classes.groupBy("digest", "class").agg(best.alias("best"), F.count("*").alias("group_size"))
    named = classes.join(groups, ["digest", "class"]).select("node", F.col("best.doc_id").alias("keep_id"), F.col("best.node").alias("keeper"), "group_size")
    out = rows.join(named, "node", "left")
    single = F.col("keeper").isNull()
    return out.select("doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      (single | (F.col("keeper") == F.col("node"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _texts(packed: DataFrame, rows: DataFrame) -> DataFrame:
    """The normalised bytes of the wanted rows; blocks are told which."""
    wanted = (rows.select(F.shiftright("node", PLACES).alias("block"), F.struct("node", "doc_id", "digest").alias("want"))
              .groupBy("block").agg(F.collect_list("want").alias("wants")))

    def each(key, left, right):
        wants = right.column("wants").combine_chunks()
        wants = (wants.chunk(0) if isinstance(wants, pa.ChunkedArray) else wants).flatten() if right.num_rows else None
        if wants is None or not left.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "doc_id": pa.array([], pa.int64()), "digest": pa.array([], pa.binary()), "bytes": pa.array([], pa.binary())})
        node, doc_id, digest = wants.flatten()
        texts = b.of_payload(left.combine_chunks().column("payload").chunk(0)[0]).column("text").take(pa.compute.bit_wise_and(node, (1 << PLACES) - 1))
        data, at = w.buffer(texts)
        raw, at = data.tobytes(), at.tolist()
        return pa.table({"node": node, "doc_id": doc_id, "digest": digest, "bytes": pa.array([normalised(raw[x:y]) for x, y in zip(at, at[1:])], pa.binary())})
    return packed.select("block", "payload").groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
        each, "node long, doc_id long, digest binary, bytes binary")


def _compared(copies: DataFrame, several: DataFrame) -> DataFrame:
    """Each copy with its class: 0 if its bytes are those of the document that its digest was found under, else by a hash of them."""
    leads = copies.select("node", "doc_id", "digest").join(several, "digest").filter(F.col("doc_id").eqNullSafe(F.col("found_id"))).groupBy("digest").agg(F.min("node").alias("node"))
    first = copies.join(leads.select("node"), "node", "left_semi").select("digest", F.col("bytes").alias("first"))
    differs = F.when(F.col("bytes") == F.col("first"), F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(1), "bytes"))
    return copies.join(first, "digest").select("node", "doc_id", "digest", differs.alias("class"))


SQL = r"""
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h from documents)
select doc_id, min(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
       doc_id = min(doc_id) over (partition by h) as kept, h as text_sha256 from t
"""
