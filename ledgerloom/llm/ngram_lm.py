"""Language-model scores from an Elias-Fano n-gram trie.

Counts of all training n-grams are gathered by shards, level by level; a shard
owns contexts (a frequent context is dealt to several shards by the next word).
A shard keeps its level of the trie in a mapped file: sorted contexts, pointers
to their successors, successors counted on from the end of the context before,
all as Elias-Fano sequences, and a quantised probability for each successor.
It answers a block's n-grams by finding the context and, relative to it, the
successor, and says which n-grams no other block has: longer n-grams that begin
or end with one of those are counted in the block itself and never sent.

Smoothing: P(w | h) = a + K / (c(h) + K) * P(w | h') with a = c(hw) / (c(h) + K),
h' the context without its first word; the trie holds a. The lowest level is
the base, (c + 0.1) / (N + 0.1 (V + 1)). Every context that training has counts,
those it has once too; one it has not passes to the shorter context, as c(h) = 0.
"""
from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w
from ledgerloom.llm.elias_fano import EliasFano
from ledgerloom.llm.quality import fold

ORDER = 3
ADDED = 0.1                  # to each count of the base
STRENGTH = {2: 100.0, 3: 2.0}  # K of a level; levels above take the last
FOLDS = 10                   # documents with crc32(id) mod FOLDS = 0 are held out
SPLIT = 100_000              # occurrences of a context for each shard it is dealt to
STEPS = 6000                 # codes for a factor of ten
PACKING = 2                  # zstd level of the blocks, which travel once for each level of the trie
END, BEGIN = np.uint64(0xE4D), np.uint64(0xBE61)
KEY = np.uint64((1 << 48) - 1)
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def encode(share: np.ndarray) -> np.ndarray:
    """Quantised logarithm of numbers in (0, 1]; 0 stays 0."""
    out = np.zeros(len(share), np.uint16)
    some = share > 0
    out[some] = np.minimum(np.round(-np.log10(share[some]) * STEPS), 65534).astype(np.uint16) + np.uint16(1)
    return out


def decode(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(float) - 1) / STEPS), 0.0)


# --- a shard's level of the trie ------------------------------------------------------------------------------------------


class Level:
    """Successors of contexts, as arrays in one file; opened by mapping it."""

    PARTS = ("vocabulary", "contexts", "pointers", "successors")

    @staticmethod
    def write(path: str, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray, totals: np.ndarray, strength: float) -> None:
        """From n-grams (some repeated) with counts above 0 and the count of each one's context."""
        vocabulary, word = w.distinct(words)
        known, context = w.distinct(contexts)
        grams, place = w.distinct(context * len(vocabulary) + word)
        summed = np.bincount(place, counts, minlength=len(grams))
        total = np.zeros(len(grams))
        total[place] = totals
        context, word = np.divmod(grams, max(1, len(vocabulary)))
        first = np.searchsorted(context, np.arange(len(known) + 1))
        # Successors go on from where the context before ended, so that the whole level rises.
        last = word[first[1:] - 1] + 1
        base = np.concatenate(([0], np.cumsum(last)[:-1])) if len(known) else np.zeros(0, np.int64)
        arrays = []
        for values in (vocabulary, known, first, base[context] + word):
            arrays += EliasFano.arrays(values.astype(np.uint64))
        arrays.append(encode(summed / (total + strength)))
        with open(path, "wb") as out:
            sizes = np.array([a.nbytes for a in arrays], np.int64)
            out.write(sizes.tobytes())
            for a in arrays:
                out.write(a.tobytes() + bytes(-a.nbytes % 8))

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r").view(np.ndarray)  # still the mapped file
        n, types = 21, ("<i8", "u1", "<u8", "<u4", "<u4")
        sizes, at, arrays = raw[:n * 8].view(np.int64), n * 8, []
        for k, size in enumerate(sizes.tolist()):
            arrays.append(raw[at:at + size].view(types[k % 5] if k < 20 else "<u2"))
            at += size + -size % 8
        for k, name in enumerate(self.PARTS):
            setattr(self, name, EliasFano(*arrays[5 * k:5 * k + 5]))
        self.codes = arrays[20]

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Codes of n-grams, 0 for those that training has not seen."""
        out = np.zeros(len(contexts), np.uint16)
        if not len(self.codes):
            return out
        (contexts, of), (words, at) = w.distinct(contexts), w.distinct(words)
        context, word = self.contexts.find(contexts), self.vocabulary.find(words)
        here = np.maximum(context, 0)
        low, high = self.pointers.access(here).astype(np.int64), self.pointers.access(here + 1).astype(np.int64)
        # The end of the context before: its last successor, one more.
        base = np.where(low > 0, self.successors.access(np.maximum(low - 1, 0)).astype(np.int64) + 1, 0)
        some = np.flatnonzero((context[of] >= 0) & (word[at] >= 0))
        of, at = of[some], at[some]
        grams, which = w.distinct(base[of] + word[at])  # sorted, so that the search goes through the level once
        place = self.successors.find(grams)[which]
        hit = (place >= low[of]) & (place < high[of])
        out[some[hit]] = self.codes[place[hit]]
        return out


# --- blocks -----------------------------------------------------------------------------------------------------------------


class Tokens:
    """A block's tokens: words and one end for each text, numbered by sorted hashes."""

    def __init__(self, rows: pa.Table):
        found = w.find(*w.buffer(rows.column("text")), w.UNBLANK, w.FOLDED)
        n = rows.num_rows
        self.first = found.first + np.arange(n + 1)  # an end after each text
        hashes = np.empty(len(found.hash) + n, np.uint64)
        hashes[np.arange(len(found.hash)) + found.text] = found.hash
        hashes[self.first[1:] - 1] = END
        self.words, self.token = w.distinct(hashes)
        self.text = np.repeat(np.arange(n), np.diff(self.first))
        self.taught = rows.column("taught").to_numpy(zero_copy_only=False).astype(bool)
        self.train = self.taught[self.text]
        self.place = np.arange(len(hashes)) - self.first[self.text]

    def counts(self) -> np.ndarray:
        return np.bincount(self.token[self.train], minlength=len(self.words)).astype(np.uint32)


class Grams:
    """Distinct n-grams of a block on one level, in order of shards and contexts."""

    def __init__(self, tokens: Tokens, context: np.ndarray, keys: np.ndarray, totals: np.ndarray, at: np.ndarray, shards: int):
        """``context``: number of the context of each token at the places ``at``; ``keys``, ``totals``: hash and count of each context."""
        n = len(tokens.words)
        grams, where = w.distinct(context[at] * n + tokens.token[at])
        of, word = np.divmod(grams, max(1, n))
        hashes = tokens.words[word]
        dealt = np.where(totals[of] > SPLIT, hashes % (1 + totals[of] // SPLIT).astype(np.uint64), np.uint64(0))
        shard = b.shard_of(w.mix(keys[of] + dealt * np.uint64(0x9E3779B97F4A7C15)), shards)
        order = np.argsort(shard, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.where, self.shard, self.of = rank[where], shard[order], of[order]
        self.word, self.names = word[order], tokens.words
        self.words, self.keys, self.totals = hashes[order], keys[self.of], totals[self.of]
        self.counts = np.bincount(self.where[tokens.train[at]], minlength=len(order)).astype(np.uint32)

    def requests(self, block: int) -> pa.RecordBatch:
        ids, starts = np.unique(self.shard, return_index=True)
        out = []
        for a, z in zip(starts, np.append(starts[1:], len(self.shard))):
            heads = np.flatnonzero(np.append(True, self.of[a + 1:z] != self.of[a:z - 1]))
            runs = np.diff(np.append(heads, z - a)).astype(np.uint32)
            # Each word is named once, by what its hash's upper 48 bits are above those of the word before; the n-grams hold its number.
            used, number = w.distinct(self.word[a:z])
            context, name = self.keys[a:z][heads] & KEY, np.diff(self.names[used] >> np.uint64(16), prepend=np.uint64(0))
            out.append(b.squeezed(b.arrays_out(context.astype(np.uint32), (context >> np.uint64(32)).astype(np.uint16), _narrow(self.totals[a:z][heads]), _narrow(runs),
                                               name.astype(np.uint32), (name >> np.uint64(32)).astype(np.uint16),
                                               (number & 255).astype(np.uint8), _narrow(number >> 8), _narrow(self.counts[a:z]))))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([block] * len(ids), pa.int64()), pa.array(out, pa.binary())],
                                          names=["shard", "block", "payload"])


def _count_words(_, payloads):
    """Total counts of words and a bit for each that no other block has; before them the shard's tokens and distinct words, as two
    big-endian numbers."""
    got = [b.arrays_in(b.unsqueezed(p)) for p in payloads]
    distinct, number = w.distinct(np.concatenate([g[0] for g in got]))
    total = np.bincount(number, np.concatenate([g[1] for g in got]), minlength=len(distinct))
    head = np.array([total.sum(), (total > 0).sum()]).astype(">i8").tobytes()
    alone, ends = np.bincount(number, minlength=len(distinct)) == 1, np.cumsum([len(g[0]) for g in got])[:-1]
    return [head + b.squeezed(b.arrays_out(_narrow(t.astype(np.uint64)), np.packbits(x))) for t, x in zip(np.split(total[number], ends), np.split(alone[number], ends))]


def _counted(payload) -> tuple[np.ndarray, np.ndarray]:
    counts, alone = b.arrays_in(b.unsqueezed(payload.as_buffer().slice(16)))
    return counts.astype(np.uint64), np.unpackbits(alone, count=len(counts)).astype(bool)


def _narrow(values: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.uint64)


def _joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)


def _look_up(strength: float, last: bool):
    """Codes of the n-grams asked for and, before the last level, a bit for each that no other block has."""
    def reply(_, payloads):
        got = [b.arrays_in(b.unsqueezed(p)) for p in payloads]
        sizes = [len(g[6]) for g in got]
        # Contexts and words are named once for a block; n-grams are pairs of their numbers.
        contexts, context = w.distinct(np.concatenate([_joined(g[0], g[1]) for g in got]))
        words, name = w.distinct(np.concatenate([np.cumsum(_joined(g[4], g[5]), dtype=np.uint64) for g in got]))
        context = np.repeat(context, np.concatenate([g[3] for g in got]))
        word = name[np.concatenate([g[6] + (g[7].astype(np.int64) << 8) + at for g, at in zip(got, np.cumsum([0, *(len(g[4]) for g in got)]))])]
        grams, which = w.distinct(context * max(1, len(words)) + word)
        counts = np.bincount(which, np.concatenate([g[8] for g in got]), minlength=len(grams))
        totals = np.zeros(len(grams), np.uint64)
        totals[which] = np.concatenate([np.repeat(g[2], g[3]) for g in got]).astype(np.uint64)
        of, word = np.divmod(grams, max(1, len(words)))
        contexts, words, seen = contexts[of], words[word], counts > 0
        with tempfile.TemporaryDirectory() as folder:
            path = os.path.join(folder, "level")
            Level.write(path, contexts[seen], words[seen], counts[seen], totals[seen], strength)
            level = Level(path)
            codes = level.find(contexts, words)[which]
            del level
        ends = np.cumsum(sizes)[:-1]
        if last:
            return [b.squeezed(b.arrays_out(c)) for c in np.split(codes, ends)]
        # A block asks for an n-gram once, so what stands here once no other block has.
        alone = (np.bincount(which, minlength=len(grams)) == 1)[which]
        return [b.squeezed(b.arrays_out(c, np.packbits(x))) for c, x in zip(np.split(codes, ends), np.split(alone, ends))]
    return reply


class _Known:
    """What a block knows of its tokens after the answers so far: counts, and probabilities level by level."""

    def __init__(self, rows: pa.Table, payloads: list[list], shards: int, n_tokens: int, n_words: int, n_texts: int):
        self.tokens = t = Tokens(rows)
        self.shards = shards
        got = [_counted(p) for p in payloads[0]]
        counts = np.concatenate([c for c, _ in got]) if got else np.zeros(0, np.uint64)
        alone = np.concatenate([x for _, x in got]) if got else np.zeros(0, bool)
        self.counts = counts.astype(np.int64)
        each = (self.counts + ADDED) / (n_tokens + ADDED * (n_words + 1))
        self.base = each[t.token]
        self.chance = self.base.copy()
        # Contexts of one word: the word before, or the beginning.
        self.context = np.empty(len(t.token), np.int64)
        self.context[1:] = t.token[:-1]
        self.context[t.place == 0] = len(t.words)
        self.keys = np.append(t.words, BEGIN)
        self.totals = np.append(self.counts, n_texts)
        self.single = alone[t.token]  # tokens that end an n-gram of the level below that no other block has
        self.level = 2
        for answers in payloads[1:]:
            self.learn(answers)

    def _places(self, alone: bool) -> np.ndarray:
        """Tokens in a context that training has. Alone are those whose n-gram begins or ends with one that no other block has."""
        known = (self.context >= 0) & (self.totals[self.context] >= (1 if self.level > 2 else 0))
        begins = np.append(False, self.single[:-1]) & (self.tokens.place > 0)
        return np.flatnonzero(known & ((begins | self.single) == alone))

    def grams(self) -> Grams:
        """What the shards are asked for."""
        return Grams(self.tokens, self.context, self.keys, self.totals, self._places(False), self.shards)

    def learn(self, answers: list) -> None:
        """Probabilities of this level, and the contexts of the next."""
        grams, k, t = self.grams(), strength_of(self.level), self.tokens
        got = [b.arrays_in(b.unsqueezed(p)) for p in answers]
        codes = np.concatenate([g[0] for g in got]) if got else np.zeros(0, np.uint16)
        alone = np.concatenate([np.unpackbits(g[1], count=len(g[0])).astype(bool) if len(g) > 1 else np.zeros(len(g[0]), bool) for g in got]) if got else np.zeros(0, bool)
        # What it has alone the block counts itself, with the same rounding.
        asked, mine, n = self._places(False), self._places(True), max(1, len(t.words))
        own, where = w.distinct(self.context[mine] * n + t.token[mine])
        of, word = np.divmod(own, n)
        counts = np.bincount(where[t.train[mine]], minlength=len(own))
        part = decode(np.concatenate((codes, encode(counts / (self.totals[of] + k)))))
        number = np.full(len(t.token), -1, np.int64)
        number[asked], number[mine] = grams.where, len(codes) + where
        total, at = self.totals[self.context], number >= 0
        self.chance[at] = part[number[at]] + k / (total[at] + k) * self.chance[at]
        # A token's n-gram is the context of the token after it, in the same text.
        self.totals = np.round(part * (np.concatenate((grams.totals, self.totals[of])) + k)).astype(np.int64)
        self.keys = np.concatenate((w.pair(grams.keys, grams.words), w.pair(self.keys[of], t.words[word])))
        self.single = np.append(np.concatenate((alone, np.ones(len(own), bool))), False)[number]  # the last for tokens without an n-gram
        context = np.full(len(number), -1, np.int64)
        context[1:] = number[:-1]
        context[t.place == 0] = -1
        self.context = context
        self.level += 1


def strength_of(level: int) -> float:
    return STRENGTH.get(level, STRENGTH[max(STRENGTH)])


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", taught=None, order: int = ORDER, block_bytes: int = b.BLOCK_BYTES) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, logarithms to base 10.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` after A-Z became a-z, then one end. Counts come from all documents for which
    ``taught`` holds (by default: crc32 of the id modulo 10 is not 0), from their whole texts. ``n_known`` tokens have
    been counted; the base score takes tokens one by one, the score in the context of the ``order`` - 1 before.

    A null or empty text is one end; repeated rows teach twice; rows without an id are held out; other columns are
    ignored; an empty table gives no rows; without training text every token has the base's chance. Long texts are whole.
    """
    scratch = b.Scratch(docs.sparkSession, "ngrams")
    learns = F.coalesce(fold(F.col(id_col), FOLDS) != 0 if taught is None else taught, F.lit(False)).alias("taught")
    packed = b.pack(scratch, docs, id_col, text_col, learns, size=block_bytes, level=PACKING)
    shards = b.shards_for(packed)

    def ask_words(block, rows):
        tokens = Tokens(rows)
        counts = tokens.counts()
        return b.requests(block, tokens.words, shards, lambda s: b.squeezed(b.arrays_out(tokens.words[s], counts[s])))
    answers = [scratch.save(b.answer(b.ask(packed, ask_words), _count_words), "words")]
    head = [F.conv(F.hex(F.substring("payload", 1 + 8 * k, 8)), 16, 10).cast("long").alias(name) for k, name in enumerate(("tokens", "words"))]
    sums = answers[0].groupBy("shard").agg(F.first("payload").alias("payload")).select(*head).agg(F.sum("tokens"), F.sum("words")).first()
    n_tokens, n_words = sums[0] or 0, sums[1] or 0
    n_texts = docs.filter(learns).count()
    facts = (shards, n_tokens, n_words, n_texts)

    for level in range(2, order + 1):
        def ask_grams(block, rows, payloads):
            return _Known(rows, payloads, *facts).grams().requests(block)
        answers.append(scratch.save(b.answer(b.ask_told(packed, answers, ask_grams), _look_up(strength_of(level), level == order)), f"level{level}"))

    def use(block, rows, payloads):
        known = _Known(rows, payloads, *facts)
        t = known.tokens
        n = np.diff(t.first)
        return pa.table({"doc_id": rows.column("id").cast(pa.int64()), "held_out": pa.array(~t.taught), "n_tokens": n,
                         "n_known": np.bincount(t.text, known.counts[t.token] > 0, minlength=len(n)).astype(np.int64),
                         "train_tokens": np.full(len(n), n_tokens), "base_score": np.bincount(t.text, np.log10(known.base), minlength=len(n)),
                         "score": np.bincount(t.text, np.log10(known.chance), minlength=len(n))})
    return b.told(packed, answers, use, RESULT)
