"""Blocks of documents, and hash requests between blocks and shards.

``pack`` writes the documents once to the shared folder, some MB of text to a
row. A row is then the unit of work: numpy functions see many texts at once,
and a lost executor costs only the blocks it had in hand. Blocks ask shards:
a block sends the hashes it holds to the shards that own them (sorted arrays,
not rows), a shard compares what all blocks sent and answers each block in the
order of its request. No text moves for a question, a key counts once per
block however often it occurs, and a hot key is one entry of each block.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir, ship

BLOCK_BYTES = 8 << 20  # of text in a block
BLOCK_ROWS = 1 << 20    # in a block, however short their texts
SHARD_BYTES = 8 << 20   # of text for each shard, so that a shard stays small at any size
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PACKED = "block long, n_texts long, n_bytes long, payload binary"
REQUEST = "shard int, block long, payload binary"


class Scratch:
    """Tables in the shared folder. They outlive executors; ``drop`` removes those no longer read."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root = ship(spark), shared_dir(spark, purpose)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table and read it from there; the shuffle files of the write go with it."""
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def to_payload(table: pa.Table, level: int = 1) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", level))) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def of_payload(value: pa.BinaryScalar) -> pa.Table:
    return pa.ipc.open_stream(value.as_buffer()).read_all().combine_chunks()


def arrays_out(*arrays: np.ndarray) -> bytes:
    """Arrays of any types and lengths as one value: for each its type, its size in bytes, its bytes padded to eight."""
    parts = []
    for a in arrays:
        parts += [a.dtype.str[1:].encode().ljust(8), a.nbytes.to_bytes(8, "little"), a.tobytes(), bytes(-a.nbytes % 8)]
    return b"".join(parts)


def squeezed(value: bytes) -> bytes:
    """The value compressed, for texts; after eight bytes with its size."""
    return len(value).to_bytes(8, "little") + pa.compress(value, "zstd", asbytes=True)


def unsqueezed(value: pa.BinaryScalar | pa.Buffer) -> pa.Buffer:
    raw = value if isinstance(value, pa.Buffer) else value.as_buffer()
    return pa.decompress(raw.slice(8), int.from_bytes(raw.slice(0, 8).to_pybytes(), "little"), "zstd")


def arrays_in(value: pa.BinaryScalar | pa.Buffer) -> list[np.ndarray]:
    raw, at, out = value if isinstance(value, pa.Buffer) else value.as_buffer(), 0, []
    while at < raw.size:
        head = raw.slice(at, 16).to_pybytes()
        size = int.from_bytes(head[8:], "little")
        out.append(np.frombuffer(raw.slice(at + 16, size), head[:8].decode().strip()))
        at += 16 + size + -size % 8
    return out


def _packer(size: int, level: int) -> Callable:
    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, n_bytes, n_rows, made = TaskContext.get().partitionId(), [], 0, 0, 0

        def row():
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_arrays([pa.array([part << 20 | made]), pa.array([table.num_rows]), pa.array([n_bytes]),
                                               pa.array([to_payload(table, level)], pa.binary())], names=["block", "n_texts", "n_bytes", "payload"])

        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            upto, i = np.concatenate(([0], np.cumsum(lengths))), 0
            while i < batch.num_rows:
                j = min(max(i + 1, int(np.searchsorted(upto, upto[i] + size - n_bytes, "right")) - 1), i + BLOCK_ROWS - n_rows)
                held.append(batch.slice(i, j - i))
                n_bytes += int(upto[j] - upto[i])
                n_rows += j - i
                if n_bytes >= size or n_rows == BLOCK_ROWS or j < batch.num_rows:
                    yield row()
                    held, n_bytes, n_rows, made = [], 0, 0, made + 1
                i = j
        if held:
            yield row()
    return pack_rows


def pieces(table: pa.Table | pa.RecordBatch, column: str = "text", size: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with some ``size`` bytes of text each; a longer text is a range of its own."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(table.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, i = np.concatenate(([0], np.cumsum(lengths))), 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(upto, upto[i] + size, "right")) - 1)
        yield i, j
        i = j


def pack(scratch: Scratch, docs: DataFrame, id_col: str, text_col: str, *more, size: int = BLOCK_BYTES, level: int = 1) -> DataFrame:
    """Rows ``id, text`` (and the columns ``more``) in blocks, stored, compressed to a ``level``. A text longer than ``size`` is a block of its own;
    no block has more than BLOCK_ROWS rows."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *more)
    return scratch.save(rows.mapInArrow(_packer(size, level), PACKED), "packed")


def shards_for(packed: DataFrame, text_bytes: int = SHARD_BYTES) -> int:
    total = packed.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return max(4, -(-total // text_bytes))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards own ranges of the upper 32 bits, so sorted hashes are sorted by shard."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def requests(block: int, hashes: np.ndarray, shards: int, send: Callable[[slice], bytes]) -> pa.RecordBatch:
    """One row for each shard that owns some of the sorted hashes; ``send`` makes the value of a slice."""
    owner = shard_of(hashes, shards)
    ids, starts = np.unique(owner, return_index=True)
    ends = np.append(starts[1:], len(hashes))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int32()), pa.array([block] * len(ids), pa.int64()),
         pa.array([send(slice(a, b)) for a, b in zip(starts, ends)], pa.binary())], names=["shard", "block", "payload"])


def ask(packed: DataFrame, make: Callable[[int, pa.Table], Iterator[pa.RecordBatch] | pa.RecordBatch]) -> DataFrame:
    """Requests of all blocks; ``make(block, rows)`` gives a block's."""
    def each(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                yield make(block, of_payload(payload))
    return packed.mapInArrow(each, REQUEST)


def answer(asked: DataFrame, reply: Callable[[int, list[pa.BinaryScalar]], list[bytes]]) -> DataFrame:
    """Each shard sees all that was asked of it; ``reply(shard, payloads)`` gives an answer for each."""
    def each(key, table):
        table = table.combine_chunks()
        out = reply(key[0].as_py(), [v for c in table.column("payload").chunks for v in c])
        return pa.table([table.column("shard"), table.column("block"), pa.array(out, pa.binary())], names=["shard", "block", "payload"])
    return asked.groupBy("shard").applyInArrow(each, REQUEST)


def told(packed: DataFrame, answers: list[DataFrame], use: Callable, schema: str) -> DataFrame:
    """Each block with the answers to its questions: ``use(block, rows, payloads)`` gives a table; ``payloads`` has a
    list for each of ``answers``, in the order of shards."""
    marked = [a.withColumn("question", F.lit(k)) for k, a in enumerate(answers)]
    every, n = marked[0], len(marked)
    for more in marked[1:]:
        every = every.unionByName(more)

    def each(key, left, right):
        right = right.sort_by([("question", "ascending"), ("shard", "ascending")]).combine_chunks()
        values = [v for c in right.column("payload").chunks for v in c]
        ends = np.cumsum(np.bincount(right.column("question").to_numpy(), minlength=n))
        return use(key[0].as_py(), of_payload(left.combine_chunks().column("payload").chunk(0)[0]), [values[a:z] for a, z in zip([0, *ends], ends)])
    return packed.select("block", "payload").groupBy("block").cogroup(every.groupBy("block")).applyInArrow(each, schema)


def ask_told(packed: DataFrame, answers: list[DataFrame], make: Callable) -> DataFrame:
    """Requests of blocks that have answers to earlier questions: ``make(block, rows, payloads)``."""
    if not answers:
        return ask(packed, lambda block, rows: make(block, rows, []))
    return told(packed, answers, lambda block, rows, payloads: pa.Table.from_batches([make(block, rows, payloads)]), REQUEST)


def seen_twice(keys: list[np.ndarray], already: list[np.ndarray]) -> list[np.ndarray]:
    """For lists of distinct keys, which keys stand in two lists or are flagged already."""
    if not keys:
        return []
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    both = same | np.append(same[1:], False)
    flags = np.empty(len(every), bool)
    flags[order] = both
    flags |= np.concatenate(already)
    return np.split(flags, np.cumsum([len(k) for k in keys])[:-1])


def narrow(hashes: np.ndarray, flags: np.ndarray) -> bytes:
    """Sorted hashes for one shard, 5 bytes each: enough to tell a shard's entries apart, not to prove equality."""
    return arrays_out(hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint8), np.packbits(flags))


def narrow_with(hashes: np.ndarray, values: np.ndarray) -> bytes:
    """As ``narrow``, with a value for each hash."""
    return arrays_out(hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint8), values)


def widen(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def flags_back(hashes: np.ndarray, shards: int, payloads: list[pa.BinaryScalar]) -> np.ndarray:
    """Bits that the shards sent for sorted hashes, in the order of the hashes."""
    if not len(hashes):
        return np.zeros(0, bool)
    sizes = np.unique(shard_of(hashes, shards), return_counts=True)[1]
    return np.concatenate([np.unpackbits(np.frombuffer(p.as_buffer(), np.uint8), count=n) for n, p in zip(sizes.tolist(), payloads, strict=True)]).astype(bool)


def repeated(asked: DataFrame) -> DataFrame:
    """Answer to (narrow hashes, flag): which hashes stand in two requests of the shard or are flagged."""
    def reply(_, payloads):
        got = [arrays_in(p) for p in payloads]
        return [np.packbits(f).tobytes() for f in
                seen_twice([widen(a, b) for a, b, _ in got], [np.unpackbits(c, count=len(a)).astype(bool) for a, _, c in got])]
    return answer(asked, reply)
