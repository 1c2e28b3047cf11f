"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Documents of a source stand in a shuffled queue. A copy's virtual finish time
is the words its source has sent up to and with it, divided by the source's
target; all copies, sorted by that time, fill the budget. Sums along a queue
are taken slice by slice (slices of the shuffle key), so that a source with a
third of all rows is many small windows, and the global cut looks at sums of
narrow bands of time first and at single rows in one band only.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SLICE_DIGITS = 3   # hex digits of the shuffle key: 4,096 slices of each source
BANDS = 512        # bands of a unit of virtual time, and again of the band in which the budget ends
LAST_BAND = 8 * BANDS


def words_in(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def rotating_weights(sources: DataFrame, steps: int = 3) -> DataFrame:
    """Sources in order of code points, null last, weigh 1, 2, ... ``steps``, and again. One row per source in one task."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    return sources.withColumn("weight", (1 + (place - 1) % steps).cast("long"))


def share(sources: DataFrame, cap: int) -> DataFrame:
    """Targets: the sum of all sizes by weight, none above ``cap`` times its source, the excess reshared by weight.

    In order of size over weight the sources that reach their cap come first. ``level`` is what a unit of weight gets
    if all before are capped; a source is capped if its own cap is lower. The number of sources is the number of rows here.
    """
    limit = F.col("source_size") * cap
    order = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), "source")
    before = F.coalesce(F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - before).cast("double") / left
    out = sources.withColumn("level", level).withColumn("capped", (limit / F.col("weight")) < F.col("level"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return out.withColumn("target", F.when(F.col("capped"), limit.cast("double")).otherwise(F.col("weight") * level)).drop("level", "capped")


def mix(docs: DataFrame, weights=rotating_weights, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cap: int = 3, seed: str = "mix") -> DataFrame:
    """One row per document: ``size``, its source's ``source_size`` and ``target``, and the words ``taken``.

    ``weights`` adds a column ``weight`` to the sources. The budget is the sum of all sizes; a document is taken whole, 0
    to ``cap`` times. The order of a queue follows a digest of the id and ``seed`` (then id, then size), so reruns agree.

    A null text has size 0 and is never taken; null is a source like any other; rows without an id go by the digest of the
    empty text; repeated rows are separate documents; ties in time go by source, digest, id and round. A document larger
    than its source's target may stay out. Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")))
    sized = scratch.save(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_in(F.col(text_col)).alias("size"),
                                     key.alias("key"), F.substring(key, 1, SLICE_DIGITS).alias("slice")), "sized")
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    sources = share(weights(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))), cap)
    queue = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (slices.withColumn("before", F.coalesce(F.sum("slice_size").over(queue), F.lit(0))).alias("o")
               .join(sources.alias("s"), F.col("o.source").eqNullSafe(F.col("s.source")))
               .select(F.col("o.source").alias("in_source"), F.col("slice").alias("in_slice"), "before", "source_size", "target"))
    within = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queued = scratch.save(
        sized.withColumn("upto", F.sum("size").over(within))
        .join(offsets, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("slice") == F.col("in_slice")))
        .select("doc_id", "source", "key", "size", "source_size", "target", (F.col("before") + F.col("upto")).alias("sent")), "queued")
    return _cut(queued, cap)


def _edge(copies: DataFrame, budget: int) -> tuple[int, int] | None:
    """The ``band`` in which the budget ends and what is left of the budget before it: two numbers. At most LAST_BAND + 1 sums meet in one task."""
    bands = copies.groupBy("band").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.orderBy("band"))
    last = (bands.select("band", "words", upto.alias("upto")).filter(F.col("upto") > budget)
            .agg(F.min(F.struct("band", "upto", "words")).alias("m")).first()["m"])
    return None if last is None else (last["band"], budget - (last["upto"] - last["words"]))


def _cut(queued: DataFrame, cap: int) -> DataFrame:
    """Copies in order of their finish until the budget is full: by sums of bands of time, of bands within the last one, and row by row in the last of those."""
    def finish(turn):
        return (F.col("source_size") * turn + F.col("sent")).cast("double") / F.col("target")

    def band(turn):
        return F.least(F.floor(finish(turn) * BANDS), F.lit(LAST_BAND))

    def inner(turn, edge):
        return F.least(F.floor((finish(turn) * BANDS - edge) * BANDS), F.lit(LAST_BAND))

    sending = (F.col("size") > 0) & (F.col("target") > 0)
    copies = queued.filter(sending).select("*", F.explode(F.array(*(F.lit(t) for t in range(cap)))).alias("turn"))
    copies = copies.withColumn("finish", finish(F.col("turn"))).withColumn("band", band(F.col("turn")))
    budget = queued.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total")).first()["total"]
    outer = _edge(copies, budget)
    if outer is None:
        taken = sum(sending.cast("long") for _ in range(cap))
        return queued.select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), (F.col("size") * taken).alias("taken"))
    copies = copies.filter(F.col("band") == outer[0]).withColumn("band", inner(F.col("turn"), outer[0]))
    edge, room = _edge(copies, outer[1])
    order = Window.orderBy("finish", F.col("source").isNull(), "source", "key", "doc_id", "turn")
    within = copies.filter(F.col("band") == edge).withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    partly = within.filter(F.col("upto") <= room).groupBy("doc_id", "source", "key", "size", "sent").agg(F.count("*").alias("more"))
    first = [(band(F.lit(t)) < outer[0]) | ((band(F.lit(t)) == outer[0]) & (inner(F.lit(t), outer[0]) < edge)) for t in range(cap)]
    before = sum(F.when(sending & f, 1).otherwise(0) for f in first)
    same = [F.col(f"q.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("doc_id", "source", "key", "size", "sent")]
    return (queued.withColumn("before", before).alias("q").join(partly.alias("p"), same, "left")
            .select("q.doc_id", "q.size", "q.source_size", F.coalesce("q.target", F.lit(0.0)).alias("target"),
                    (F.col("q.size") * (F.col("before") + F.coalesce("more", F.lit(0)))).cast("long").alias("taken")))


SQL = """
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         md5(concat_ws(':', 'mix', doc_id::varchar)) as key from documents),
weighed as (
  select source, sum(size)::bigint as source_size, 1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from sized group by source),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(3 * source_size) over (order by 3 * source_size / weight, source nulls last
              rows between unbounded preceding and 1 preceding), 0))::double
            / sum(weight) over (order by 3 * source_size / weight, source nulls last rows between current row and unbounded following) as level
  from weighed),
targets as (
  select source, source_size, case when 3 * source_size / weight < level then (3 * source_size)::double
         else weight * max(case when not (3 * source_size / weight < level) then level end) over () end as target
  from levels),
queued as (
  select s.*, t.source_size, t.target, sum(size) over (partition by s.source order by key, doc_id, size
         rows between unbounded preceding and current row)::bigint as sent
  from sized s join targets t on s.source is not distinct from t.source),
copies as (
  select *, (turn * source_size + sent)::double / target as finish
  from queued, (select unnest(range(3)) as turn) where size > 0 and target > 0),
cut as (
  select *, sum(size) over (order by finish, source nulls last, key, doc_id, turn rows between unbounded preceding and current row) as upto
  from copies),
copied as (
  select doc_id, key, source, size, sent, count(*) as n from cut where upto <= (select sum(size) from sized) group by all)
select q.doc_id, q.size, q.source_size, coalesce(q.target, 0) as target, (q.size * coalesce(c.n, 0))::bigint as taken
from queued q left join copied c on q.doc_id is not distinct from c.doc_id and q.key = c.key
  and q.source is not distinct from c.source and q.size = c.size and q.sent = c.sent
"""
