"""What filters do to a corpus in every order, from one pass over the documents.

A document that fails some of five filters is one 32-bit word: bit ``s`` is set
if it survives the filters of the subset ``s``, that is, fails none of them.
Adding such words bit by bit gives the survivors of all 32 subsets at once,
and every question about an order of filters is a difference of two of them.
The bits are added by carry-save adders: three words of a weight become one of
that weight and one of twice the weight, on whole arrays.

A document's own filters are looked at once, and what is stored of it is its
id, its part, five bits and a digest of its text. Copies meet by digest; the
rest are sums, so a part or a text that holds most rows costs no task more.
"""
from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.session import ship

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
FEWEST_WORDS = 200     # A: fewer words fail
LEAST_DISTINCT = 50    # B: percent of the words; less fails
MOST_CAPITALS = 3      # C: percent of the code points; more fails
MARKS = b"#$%&*|"      # D: any of them fails
CAPITALS = bytes(range(0x41, 0x5B))
INNER = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
LANES = 64             # words that are added side by side
HELD = 1 << 16         # words of a class that wait to be added together
CLASSES = 4096         # of part and labels that a task holds
SPAN = 1 << 20         # bytes of a text that are split into words at a time
FACTS = "doc_id long, part string, failing int, digest binary"
TALLY = "part string, good boolean, toxic boolean, survivors array<long>"
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _spans(raw: bytes) -> Iterator[bytes]:
    """The text in spans that end with a word."""
    at = 0
    while at < len(raw):
        gap = BLANK.search(raw, at + SPAN)
        stop = gap.start() if gap else len(raw)
        yield raw[at:stop]
        at = stop


def failing(raw: bytes) -> int:
    """Bits 0 to 3: whether a text in UTF-8 fails the filters A to D."""
    n, distinct = 0, set()
    for span in _spans(raw):
        words = span.split()  # of bytes: at white space of ASCII alone
        n += len(words)
        distinct.update(words)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    points = len(raw.translate(None, INNER))
    return (n < FEWEST_WORDS) | (100 * len(distinct) < LEAST_DISTINCT * n) << 1 | (100 * capitals > MOST_CAPITALS * points) << 2 \
        | (len(raw.translate(None, MARKS)) < len(raw)) << 3


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("text")
        raws = (column[i].as_buffer().to_pybytes() if column[i].is_valid else b"" for i in range(batch.num_rows))
        found = [(failing(raw), hashlib.sha256(raw).digest()) for raw in raws]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array([f for f, _ in found], pa.int32()), pa.array([d for _, d in found], pa.binary())],
            names=["doc_id", "part", "failing", "digest"])


def survival_words() -> np.ndarray:
    """For each set of failed filters, the word of the subsets that it survives."""
    sets = np.arange(SUBSETS)
    return ((sets[:, None] & sets == 0).astype(np.uint32) << np.arange(SUBSETS, dtype=np.uint32)).sum(1, dtype=np.uint32)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each bit set."""
    total, weight = np.zeros(32, np.int64), 1
    level = np.concatenate((words, np.zeros(-len(words) % LANES, np.uint32))).reshape(-1, LANES)
    while len(level):
        carries = []
        while len(level) >= 3:
            k = len(level) // 3
            one, two, three = level[:k], level[k:2 * k], level[2 * k:3 * k]
            half = one ^ two
            carries.append(one & two | three & half)
            level = np.concatenate((half ^ three, level[3 * k:]))
        total += weight * (level[:, :, None] >> np.arange(32, dtype=np.uint32) & np.uint32(1)).sum((0, 1), dtype=np.int64)
        level, weight = np.concatenate(carries) if carries else level[:0], weight * 2
    return total


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = survival_words()
    held: dict[tuple, list[np.ndarray]] = {}
    sums: dict[tuple, np.ndarray] = {}

    def add(key: tuple) -> None:
        sums[key] = sums.get(key, 0) + positional_popcount(np.concatenate(held.pop(key)))

    def out() -> pa.RecordBatch:
        for key in list(held):
            add(key)
        keys = list(sums)
        rows = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([k[2] for k in keys], pa.bool_()),
             pa.array([sums[k].tolist() for k in keys], pa.list_(pa.int64()))], names=["part", "good", "toxic", "survivors"])
        sums.clear()
        return rows

    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        names, words = parts.dictionary.to_pylist(), table[batch.column("failing").to_numpy()]
        codes = parts.indices.to_numpy().astype(np.int64) * 4 + batch.column("good").to_numpy(zero_copy_only=False) * 2 + batch.column("toxic").to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        found, starts = np.unique(codes[order], return_index=True)
        for code, some in zip(found.tolist(), np.split(words[order], starts[1:])):
            key = names[code >> 2], bool(code & 2), bool(code & 1)
            held.setdefault(key, []).append(some)
            if sum(map(len, held[key])) >= HELD:
                add(key)
        if len(held.keys() | sums.keys()) > CLASSES:
            yield out()
    if held or sums:
        yield out()


def survivors(rows: DataFrame) -> DataFrame:
    """``part`` and three arrays of 32 counts (``all``, ``good``, ``toxic``): the rows that survive each subset of filters.

    ``rows`` has ``part``, ``failing`` (a bit for each filter) and the flags ``good`` and ``toxic``, none of them null.
    """
    tally = rows.select("part", "failing", "good", "toxic").mapInArrow(_tally, TALLY)

    def counts(name: str, condition: Column | None) -> Column:
        at = [F.col("survivors")[s] for s in range(SUBSETS)]
        return F.array(*(F.sum(x if condition is None else F.when(condition, x).otherwise(F.lit(0).cast("long"))) for x in at)).alias(name)
    return tally.groupBy("part").agg(counts("all", None), counts("good", F.col("good")), counts("toxic", F.col("toxic")))


def every_order(counted: DataFrame) -> DataFrame:
    """From ``survivors``: for each part one row for each order of the filters and each step in it."""
    n = len(FILTERS)
    orders = F.lit(["".join(p) for p in itertools.permutations(FILTERS)])
    steps = counted.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))

    def bit(at: str) -> str:
        return f"shiftleft(1, ascii(substring(filter_order, {at}, 1)) - {ord(FILTERS[0])})"

    placed = steps.select("*", F.expr(bit("step")).alias("bit"), F.expr(f"aggregate(sequence(1, {n}), 0, (m, i) -> m + if(i < step, {bit('i')}, 0))").alias("before"))

    def at(counts: str, subset: Column) -> Column:
        return F.get(F.col(counts), subset)

    def lost(counts: str) -> Column:
        return at(counts, F.col("before")) - at(counts, F.col("before") + F.col("bit"))

    shares = F.lit([math.factorial(bin(s).count("1")) * math.factorial(max(0, n - 1 - bin(s).count("1"))) for s in range(SUBSETS)])
    shapley = F.aggregate(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), F.lit(0).cast("long"), lambda total, s: total + F.when(
        s.bitwiseAND(F.col("bit")) == 0, F.get(shares, s).cast("long") * (at("all", s) - at("all", s + F.col("bit")))).otherwise(F.lit(0).cast("long")))
    full = SUBSETS - 1
    return placed.select(
        "part", "filter_order", "step", at("all", F.col("before") + F.col("bit")).alias("kept"), lost("all").alias("removed"),
        (at("all", F.lit(0)) - at("all", F.col("bit")) - lost("all")).alias("redundant"),
        (at("all", F.lit(full) - F.col("bit")) - at("all", F.lit(full))).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``, for all 120 orders of the five filters.

    The filters: A, fewer than 200 words; B, less than half of the words distinct; C, more than 3 % capital letters of ASCII; D, any of
    ``#$%&*|``; E, the same text as a document of smaller id. All counts are of documents within the part.

    Null and empty texts have no words and no characters (they fail A, and E after the first); texts of any length are read whole. A null
    part is the part ''. A document without an id never fails E, makes no other fail it, and has no label. Repeated rows count each; those
    with one id do not fail E through each other. An id with several labels is good (toxic) if one of them is 1. Other columns are ignored;
    an empty table gives no rows. Texts are equal if their SHA-256 is.
    """
    ship(docs.sparkSession)
    scratch = b.Scratch(docs.sparkSession, "filter-audit")
    facts = scratch.save(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                                     F.col(text_col).cast("string").alias("text")).mapInArrow(_facts, FACTS), "facts")
    firsts = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("digest", "first")
    flags = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    ).filter("good or toxic")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    rows = facts.join(firsts, "digest", "left").select("doc_id", "part", (F.col("failing") + F.when(copy, 16).otherwise(0)).alias("failing"))
    rows = rows.join(flags, "doc_id", "left").select("part", "failing", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    return every_order(survivors(rows))


SQL = r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce("text", '') as t, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as words from documents),
flagged as (
  select part,
    len(words) < 200 as a, 100 * len(list_distinct(words)) < 50 * len(words) as b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) as c,
    regexp_matches(t, '[#$%&*|]') as d, coalesce(doc_id > min(doc_id) over (partition by t), false) as e,
    exists (select 1 from labels l where l.doc_id = texts.doc_id and l.quality = 1) as good,
    exists (select 1 from labels l where l.doc_id = texts.doc_id and l.toxic = 1) as toxic
  from texts),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select p.x || q.x || r.x || s.x || t.x as o from letters p, letters q, letters r, letters s, letters t
  where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps as (select o, step, substring(o, step, 1) as f, substring(o, 1, step - 1) as earlier from orders, range(1, 6) r(step)),
kinds as (
  select part, a, b, c, d, e, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as x,
    (case when a then 'A' else '' end) || (case when b then 'B' else '' end) || (case when c then 'C' else '' end)
      || (case when d then 'D' else '' end) || (case when e then 'E' else '' end) as fails
  from flagged group by all),
run as (
  select k.part, s.o, s.step, s.f, k.n, k.g, k.x, contains(k.fails, s.f) as failed, k.fails = s.f as alone,
    len(list_intersect(string_split(s.earlier, ''), string_split(k.fails, ''))) > 0 and s.earlier <> '' and k.fails <> '' as gone
  from kinds k, steps s),
told as (
  select part, o, step, f, coalesce(sum(n) filter (not gone and not failed), 0) as kept, coalesce(sum(n) filter (not gone and failed), 0) as removed,
    coalesce(sum(n) filter (gone and failed), 0) as redundant, coalesce(sum(n) filter (alone), 0) as unique_fails,
    coalesce(sum(g) filter (not gone and failed), 0) as good_lost, coalesce(sum(x) filter (not gone and failed), 0) as toxic_lost
  from run group by part, o, step, f)
select part, o as filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, f))::bigint as shapley
from told
"""
