"""Which tokens of two tokenizers stand for the same bytes, and how usual each pairing is.

Both tokenizers cut a text into intervals of bytes. All intervals are sorted by
their start and their ends accumulated to a running maximum: where a start
reaches it, both tokenizers have just ended a token, and a new group begins.
Within a group every token of A is linked with every token of B. How many
documents hold a pair of ids linked is counted over the whole corpus, and each
document then learns how usual its links are.

A text is cut into chunks at single spaces between visible characters, which no
token of either vocabulary crosses (checked when they are loaded), so that the
distinct chunks of a block are encoded and aligned once, all in one call. A
block stores its distinct pairs beside its documents' counts; only the pairs
travel, once for each block however often they occur.
"""
from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MOST_BYTES = 32 << 20  # of a vocabulary file, which every task holds
SPACE = "▁"       # U+2581, for a space in the pieces
BLOCK_BYTES = 8 << 20  # of text in a block
CALL = 1 << 16         # characters that are encoded in one call
STEP = 1 << 15         # chunks that are aligned at once
CUT = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])")
CLEAR = re.compile(r"[\w!-~](?:.*[\w!-~])?", re.S)  # begins and ends with characters beside which the text may be cut
ALIGNED = "block long, pairs array<long>, holders array<long>, payload binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself and the others, in order, as the letters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in printable]
    return {chr(x): x for x in printable} | {chr(0x100 + k): x for k, x in enumerate(others)}


class ByteLevel:
    """Tokens of a byte-level vocabulary of the tokenizers library, for a text with a space before it."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        letters = _byte_letters()
        self.table = [b""] * self.tokenizer.get_vocab_size()
        for entry, i in spec["model"]["vocab"].items():
            self.table[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        steps = spec.get("pre_tokenizer") or {}
        self.cuts = steps.get("type") == "ByteLevel" and steps.get("use_regex", False) and not spec.get("normalizer")

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(" " + text, add_special_tokens=False).ids


class Pieces:
    """Tokens of a sentencepiece vocabulary, which puts a space before the text itself."""

    def __init__(self, raw: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.table = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(SPACE, " ").encode() for i, n in enumerate(names)]
        self.cuts = not any(SPACE in n.lstrip(SPACE) for n in names)

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Vocabulary:
    """A tokenizer with the bytes and decimal names of its ids."""

    def __init__(self, tokens: ByteLevel | Pieces):
        self.encode, self.cuts, self.table = tokens.encode, tokens.cuts, tokens.table
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        self.names = np.array([[f"{i}{sign}" for i in range(len(self.table))] for sign in ",|;"], object)

    def bytes_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


class Aligned(NamedTuple):
    """Of each chunk: its numbers of tokens, groups and links, its groups as text, and its linked pairs with how often each is linked."""
    fine: np.ndarray    # whether both tokenizers keep its bytes
    counts: np.ndarray  # n_a, n_b, n_groups, n_links: a row for each chunk
    groups: list[str]
    first: np.ndarray   # of its pairs; one more than chunks
    pairs: np.ndarray   # id of A << 32 | id of B, distinct and sorted within a chunk
    times: np.ndarray


def _tokens(vocabulary: Vocabulary, chunks: list[str], together: list[int], alone: list[int], fine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all chunks and the chunk of each, in the order of the chunks; chunks whose bytes are not kept have none and lose ``fine``."""
    ids: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    at = 0
    while at < len(together):
        stop, size = at, 0
        while stop < len(together) and (stop == at or size < CALL):
            size += len(chunks[together[stop]]) + 1
            stop += 1
        some = together[at:stop]
        text = " ".join([chunks[k] for k in some])
        got = vocabulary.encode(text)
        ends = np.cumsum([len(chunks[k].encode()) + 1 for k in some])
        token_ends = np.cumsum(vocabulary.sizes[got])
        if vocabulary.bytes_of(got) == b" " + text.encode() and np.isin(ends, token_ends).all():
            ids.append(np.array(got, np.int64))
            owners.append(np.array(some, np.int64)[np.searchsorted(ends, token_ends)])
        else:
            alone = [*alone, *some]
        at = stop
    for k in alone:
        got = vocabulary.encode(chunks[k])
        if vocabulary.bytes_of(got) == b" " + chunks[k].encode():
            ids.append(np.array(got, np.int64))
            owners.append(np.full(len(got), k, np.int64))
        else:
            fine[k] = False
    every, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, owners))
    order = np.argsort(owner, kind="stable")
    return every[order], owner[order]


def coalesced(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the intervals by start, and the group of each in that order."""
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """Starts of the runs of equal keys in sorted rows."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts: the entry of each unit, and its place within the entry."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def align_chunks(chunks: list[str], a: Vocabulary, c: Vocabulary) -> Aligned:
    """Tokens, groups and links of chunks, each with a space before it."""
    n = len(chunks)
    fine = np.ones(n, bool)
    clear = [bool(CLEAR.fullmatch(x)) and SPACE not in x for x in chunks]
    together, alone = [k for k in range(n) if clear[k]], [k for k in range(n) if not clear[k]]
    (ids_a, own_a), (ids_b, own_b) = (_tokens(v, chunks, together, alone, fine) for v in (a, c))
    if not fine.all():
        keep_a, keep_b = fine[own_a], fine[own_b]
        ids_a, own_a, ids_b, own_b = ids_a[keep_a], own_a[keep_a], ids_b[keep_b], own_b[keep_b]
    # The chunks that are kept stand one after the other on one line of bytes, the same for both tokenizers.
    ids, owner = np.concatenate((ids_a, ids_b)), np.concatenate((own_a, own_b))
    size_a, size_b = a.sizes[ids_a], c.sizes[ids_b]
    end = np.concatenate((np.cumsum(size_a), np.cumsum(size_b)))
    kind = np.repeat(np.array([0, 1], np.int8), (len(ids_a), len(ids_b)))
    order, group = coalesced(end - np.concatenate((size_a, size_b)), end, kind)
    by_kind = np.lexsort((order, kind[order], group))  # A before B within a group, each in the order of the text
    order, group = order[by_kind], group[by_kind]
    ids, owner, kind = ids[order], owner[order], kind[order]

    # Groups as text: after each id a comma, a bar before the tokens of B, a semicolon at the end of a group.
    sign = np.zeros(len(ids), np.int8)
    if len(ids):
        sign[:-1] = np.where(group[1:] != group[:-1], 2, kind[1:] != kind[:-1])
        sign[-1] = 2
    names, of_a = np.empty(len(ids), object), kind == 0
    names[of_a], names[~of_a] = a.names[sign[of_a], ids[of_a]], c.names[sign[~of_a], ids[~of_a]]
    ends, at, groups = np.cumsum(np.bincount(owner, minlength=n)).tolist(), 0, []
    for end in ends:
        groups.append("".join(names[at:end])[:-1])
        at = end
    del names, of_a, sign

    # Links: distinct ids of each side of a group with their numbers, then all pairs of them.
    first = _runs([group]) if len(ids) else np.zeros(0, np.int64)
    group_owner = owner[first]
    n_groups = np.bincount(group_owner, minlength=n)
    n_a, n_b = np.bincount(own_a, minlength=n), np.bincount(own_b, minlength=n)
    per_a, per_b = (np.bincount(group[kind == k], minlength=len(first)) for k in (0, 1))
    n_links = np.bincount(group_owner, weights=per_a * per_b, minlength=n).astype(np.int64)
    sides = []
    for k in (0, 1):
        mine = kind == k
        g, x = group[mine], ids[mine]
        o = np.lexsort((x, g))
        g, x = g[o], x[o]
        heads = _runs([g, x]) if len(g) else np.zeros(0, np.int64)
        sides.append((g[heads], x[heads], np.diff(np.append(heads, len(g)))))
    (ga, xa, ta), (gb, xb, tb) = sides
    from_b, to_b = np.searchsorted(gb, ga), np.searchsorted(gb, ga, "right")
    left, place = _spread(to_b - from_b)
    right = from_b[left] + place
    pairs, times, of = xa[left] << 32 | xb[right], ta[left] * tb[right], group_owner[ga[left]]
    o = np.lexsort((pairs, of))
    pairs, times, of = pairs[o], times[o], of[o]
    heads = _runs([of, pairs]) if len(of) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, heads) if len(heads) else times
    return Aligned(fine, np.stack((n_a, n_b, n_groups, n_links), 1), groups, np.searchsorted(of[heads], np.arange(n + 1)), pairs[heads], times)


def align_all(chunks: list[str], a: Vocabulary, c: Vocabulary) -> Aligned:
    """As ``align_chunks``, some chunks at a time."""
    parts = [align_chunks(chunks[k:k + STEP], a, c) for k in range(0, len(chunks), STEP)] or [align_chunks([], a, c)]
    fine, counts, groups, first, pairs, times = zip(*parts)
    base = np.cumsum([0, *map(len, pairs)])
    return Aligned(np.concatenate(fine), np.concatenate(counts), [g for some in groups for g in some],
                   np.concatenate([*(f[:-1] + at for f, at in zip(first, base)), base[-1:]]), np.concatenate(pairs), np.concatenate(times))


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows in tables of some ``size`` bytes of text; a longer text is a table of its own."""
    held, n = [], 0
    for batch in batches:
        for i, j in b.pieces(batch, size=max(1, size // 4)):
            part = batch.slice(i, j - i)
            n += part.column("text").nbytes
            held.append(part)
            if n >= size or sum(x.num_rows for x in held) >= b.BLOCK_ROWS:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Block(NamedTuple):
    pairs: np.ndarray    # distinct in the block, sorted
    holders: np.ndarray  # documents that hold each
    counts: np.ndarray   # n_a, n_b, n_groups, n_links: a row for each document
    groups: list[str]    # of each document
    n_pairs: np.ndarray  # distinct pairs of each document
    place: np.ndarray    # of each document's pairs among those of the block
    times: np.ndarray


def align_texts(texts: list[str | None], a: Vocabulary, c: Vocabulary) -> Block:
    numbers: dict[str, int] = {}
    cuts, spans = a.cuts and c.cuts, []
    for text in texts:
        parts = [] if not text else CUT.split(text) if cuts else [text]
        spans.append(np.array([numbers.setdefault(p, len(numbers)) for p in parts], np.int64))
    known = align_all(list(numbers), a, c)
    spans = [s if known.fine[s].all() else s[:0] for s in spans]
    groups = [";".join(map(known.groups.__getitem__, s.tolist())) for s in spans]
    pairs, kind_of = np.unique(known.pairs, return_inverse=True)
    counts, n_pairs, places, often = np.zeros((len(spans), 4), np.int64), np.zeros(len(spans), np.int64), [], []
    for k, span in enumerate(spans):
        # The document's chunks with how often each occurs, then their pairs summed.
        chunk, repeats = np.unique(span, return_counts=True)
        counts[k] = repeats @ known.counts[chunk]
        row, at = _spread(known.first[chunk + 1] - known.first[chunk])
        entry = known.first[chunk[row]] + at
        place, of = np.unique(kind_of[entry], return_inverse=True)
        places.append(place)
        often.append(np.bincount(of, weights=known.times[entry] * repeats[row], minlength=len(place)).astype(np.int64))
        n_pairs[k] = len(place)
    place, times = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, often))
    holders = np.bincount(place, minlength=len(pairs))
    if not holders.all():  # pairs of chunks whose documents lost all tokens to another chunk
        held = np.flatnonzero(holders)
        pairs, holders, place = pairs[held], holders[held], np.searchsorted(held, place)
    return Block(pairs, holders, counts, groups, n_pairs, place, times)


def _narrow(values: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _align(vocabularies, size: int, with_groups: bool):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c = Vocabulary(ByteLevel(vocabularies.value[0])), Vocabulary(Pieces(vocabularies.value[1]))
        part = TaskContext.get().partitionId()
        for made, rows in enumerate(_gathered(batches, size)):
            got = align_texts(rows.column("text").to_pylist(), a, c)
            ids = rows.column("id").combine_chunks()
            ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
            digests = [hashlib.sha256(g.encode()).digest() if g else b"" for g in got.groups]
            numbers = b.arrays_out(
                ids.fill_null(0).to_numpy(), np.packbits(ids.is_valid().to_numpy(zero_copy_only=False)), got.counts.ravel(), np.frombuffer(b"".join(digests), np.uint8),
                _narrow(got.n_pairs), got.place.astype(np.uint32), _narrow(got.times),
                np.frombuffer(json.dumps(got.groups if with_groups else []).encode(), np.uint8))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 20 | made]), pa.array([got.pairs], pa.list_(pa.int64())), pa.array([got.holders], pa.list_(pa.int64())),
                 pa.array([b.squeezed(numbers)], pa.binary())], names=["block", "pairs", "holders", "payload"])
    return each


def _told(with_groups: bool):
    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        value = left.combine_chunks().column("payload").chunk(0)[0]
        ids, known, counts, digests, n_pairs, place, times, texts = b.arrays_in(b.unsqueezed(value))
        counts, times, n = counts.reshape(-1, 4), times.astype(np.int64), len(ids)
        order = np.argsort(right.column("pair").to_numpy())
        usual, best = right.column("n").to_numpy()[order], right.column("best").to_numpy()[order]
        upto = np.zeros((len(place) + 1, 2), np.int64)
        if len(place):
            np.cumsum(times * best[place], out=upto[1:, 0])
            np.cumsum(times * usual[place], out=upto[1:, 1])
        ends = np.cumsum(n_pairs.astype(np.int64))
        sums = upto[ends] - upto[ends - n_pairs]
        raw, at, names = digests.tobytes().hex(), 0, []
        for tokens in counts[:, 0].tolist():
            names.append(raw[at:at + 64] if tokens else "")
            at += 64 * bool(tokens)
        columns = [pa.array(ids, mask=~np.unpackbits(known, count=n).astype(bool)), *(pa.array(counts[:, k]) for k in range(4)), pa.array(sums[:, 0]), pa.array(sums[:, 1]), pa.array(names, pa.string())]
        titles = RESULT.replace(" long", "").replace(" string", "").split(", ")
        if with_groups:
            columns, titles = [*columns, pa.array(json.loads(texts.tobytes()), pa.string())], [*titles, "groups"]
        return pa.table(columns, names=titles)
    return each


def _files(spark, *paths: str):
    raws = [Path(p).read_bytes() for p in paths]
    if max(map(len, raws)) > MOST_BYTES:
        raise ValueError(f"a vocabulary file has over {MOST_BYTES} bytes; every task would hold it")
    return spark.sparkContext.broadcast(raws)


def _stored(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str, block_bytes: int, with_groups: bool) -> tuple[b.Scratch, DataFrame]:
    scratch = b.Scratch(docs.sparkSession, "token-alignment")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return scratch, scratch.save(rows.mapInArrow(_align(_files(docs.sparkSession, a_path, b_path), block_bytes, with_groups), ALIGNED), "aligned")


def _counted(aligned: DataFrame) -> DataFrame:
    """``pair, n, best``: documents that hold each pair linked, and whether no pair of its A id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "holders")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.holders").alias("n"))
    counts = each.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 32))
    most = F.max("n").over(Window.partitionBy("a"))  # an A id has at most as many rows as B has ids
    return counts.withColumn("best", F.col("n") == most)


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The correspondence of two vocabularies on a corpus: ``a_id, b_id, documents, best``, one row for each pair of ids that is linked anywhere.

    ``best`` marks the pairs that most documents hold for their A id, ties included. Rows as in ``alignment``.
    """
    _, aligned = _stored(docs, id_col, text_col, a_path, b_path, block_bytes, False)
    return _counted(aligned).select(F.col("a").cast("int").alias("a_id"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b_id"), F.col("n").alias("documents"), "best")


def alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str = BYTE_BPE, b_path: str = PIECES,
              block_bytes: int = BLOCK_BYTES, with_groups: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` (and ``groups``, the text behind the digest).

    A encodes a space and the text, B the text, before which it puts a space itself; special tokens in a text are plain text. Byte offsets where
    tokens of both end cut them into groups; all pairs of an A and a B token in one group are links. ``n_best`` counts links whose pair of ids is in
    as many documents as any pair of that A id, ``count_sum`` adds the documents of all links. ``groups`` is ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte (A's or B's bytes joined are not the space and the text, as
    with U+2581), have no tokens: zeros and an empty string. Texts of any length are encoded whole. Every row is a document of its own, also with a
    repeated or null id. Other columns are ignored; an empty table gives no rows. The vocabulary files (32 MB at most) are read by the driver and sent to the tasks;
    B must normalise words independently of each other.
    """
    _, aligned = _stored(docs, id_col, text_col, a_path, b_path, block_bytes, with_groups)
    asked = aligned.select(F.col("block").alias("home"), F.explode("pairs").alias("pair"))
    answers = asked.join(_counted(aligned).select("pair", "n", "best"), "pair").select("home", "pair", "n", "best")
    schema = RESULT + (", groups string" if with_groups else "")
    return aligned.select("block", "payload").groupBy("block").cogroup(answers.groupBy("home")).applyInArrow(_told(with_groups), schema)
