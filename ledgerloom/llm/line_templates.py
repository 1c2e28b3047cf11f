"""Line deduplication with a fixed-depth tree of line templates, in DataFrame operations only.

A line's path in the tree is its number of words and its leading words, where
a word with a digit counts as a variable field. The words after them form a
fixed number of fields. Within a leaf, a field that few lines share at its
place is variable too and becomes a wildcard; a line whose template keeps
enough constant places takes that template, any other line keeps its own
words. A template that recurs in enough documents, in different surroundings,
is dropped everywhere. (Lines that recur together with their neighbours are
copied passages. Those are left to the operators for documents and substrings,
which keep one copy; dropping them here would empty every copy.)
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.blocks import Scratch

DEPTH, FIELDS = 3, 8
SIMILARITY = 0.5   # least share of constant places
SUPPORT = 5        # lines that share a field at its place, for the field to be constant
MIN_DOCS = 5       # documents in which a dropped template stands, and surroundings
APART = 0.5        # least number of different surroundings for each of those documents
NEAR = 40          # characters of the lines before and after that make the surroundings
MASKED = r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*"
GAPS = r"[\x20\x09-\x0D]+"


def _lines(text) -> F.Column:
    return F.split(text, "\n", -1)


def parsed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with words: where it stands, its leaf, its masked words and its fields as hashes, and its surroundings."""
    text = F.col(text_col)
    marked = F.transform("lines", lambda line: F.xxhash64(F.substring(line, 1, NEAR)))
    edge = F.array(F.lit(0).cast("long"))
    n = F.size("lines")
    lines = (docs.filter(text.isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), _lines(text).alias("lines"))
             .withColumn("near", marked)
             .select("doc_id", "text_hash", F.posexplode(F.arrays_zip(
                 F.col("lines").alias("line"), F.concat(edge, F.slice("near", 1, n - 1)).alias("before"),
                 F.concat(F.slice("near", 2, n), edge).alias("after"))).alias("line_no", "at"))
             .select("doc_id", "text_hash", "line_no", "at.before", "at.after",
                     F.when(F.col("at.line").rlike("[0-9]"), F.regexp_replace("at.line", MASKED, "<*>")).otherwise(F.col("at.line")).alias("line"))
             .withColumn("words", F.filter(F.split("line", GAPS), lambda x: x != "")).filter(F.size("words") > 0))
    n, rest = F.size("words"), F.size("words") - DEPTH
    width = F.ceil(rest / F.lit(FIELDS)).cast("int")
    fields = F.when(rest > 0, F.transform(F.sequence(F.lit(0), F.ceil(rest / width).cast("int") - 1),
                                          lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i * width + (DEPTH + 1), width)))))
    return lines.select("doc_id", "text_hash", "line_no", F.xxhash64("before", "after").alias("near"),
                        F.xxhash64(n, F.concat_ws(" ", F.slice("words", 1, DEPTH))).alias("leaf"), F.xxhash64(F.concat_ws(" ", "words")).alias("line"),
                        F.coalesce(fields, F.array().cast("array<bigint>")).alias("fields"))


def generalised(variants: DataFrame) -> DataFrame:
    """The template of each variant (distinct masked line, with its count ``n``) that shares its leaf with others."""
    leaves = variants.groupBy("leaf").agg(F.count("*").alias("kinds"), F.sum("n").alias("lines")).filter((F.col("kinds") > 1) & (F.col("lines") >= SUPPORT))
    places = variants.join(leaves, "leaf", "left_semi").select("leaf", "line", "n", F.posexplode("fields").alias("place", "field"))
    support = places.groupBy("leaf", "place", "field").agg((F.sum("n") >= SUPPORT).alias("constant"))
    wild = F.lit(0).cast("long")
    drawn = (places.join(support, ["leaf", "place", "field"]).groupBy("leaf", "line")
             .agg(F.sum(F.col("constant").cast("int")).alias("constants"), F.count("*").alias("places"),
                  F.array_sort(F.collect_list(F.struct("place", F.when(F.col("constant"), F.col("field")).otherwise(wild).alias("field")))).alias("drawn")))
    alike = (F.col("constants") + DEPTH) / (F.col("places") + DEPTH) >= SIMILARITY
    return drawn.filter(alike).select("leaf", "line", F.xxhash64("leaf", "drawn.field").alias("template"))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, gone``: the line numbers (from 0) that each document loses; only documents that lose some.

    Blank lines have no template and stay; a null text has no lines; repeated rows share one row here and count once;
    an empty table gives no rows; long texts are worked on line by line.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = scratch.save(parsed(docs, id_col, text_col), "lines")
    busy = scratch.save(lines.join(lines.groupBy("leaf").count().filter(F.col("count") >= MIN_DOCS), "leaf", "left_semi"), "busy")
    variants = busy.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.first("fields").alias("fields"))
    named = (busy.drop("fields").join(generalised(variants), ["leaf", "line"], "left")
             .withColumn("template", F.coalesce("template", F.xxhash64("leaf", "line"))).drop("leaf", "line"))
    named = scratch.save(named, "named")
    scratch.drop("lines", "busy")
    in_docs = named.select("template", "doc_id", "text_hash").distinct().groupBy("template").agg(F.count("*").alias("docs"))
    near = named.select("template", "near").distinct().groupBy("template").agg(F.count("*").alias("places"))
    boiler = (in_docs.filter(F.col("docs") >= MIN_DOCS).join(near.filter(F.col("places") >= MIN_DOCS), "template")
              .filter(F.col("places") >= F.col("docs") * APART))
    return named.join(boiler, "template", "left_semi").groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("gone"))


def _with_gone(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    gone = recurring_lines(docs, id_col, text_col).alias("g")
    return docs.alias("d").join(gone, F.col(f"d.{id_col}").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(f"d.{text_col}") == F.col("g.text_hash")), "left")


def _kept(text_col: str) -> F.Column:
    text, gone = F.col(f"d.{text_col}"), F.col("g.gone")
    return F.when(gone.isNull(), text).otherwise(F.array_join(F.filter(_lines(text), lambda line, i: ~F.array_contains(gone, i)), "\n"))


def drop_recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all rows and columns, without the lines of recurring templates. A null text stays null; a text may become empty."""
    return _with_gone(docs, id_col, text_col).select(*(_kept(text_col).alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its lines, how many go, and a digest of what stays. A null text has no lines."""
    text = F.col(f"d.{text_col}")
    return _with_gone(docs, id_col, text_col).select(
        F.col(f"d.{id_col}").alias("doc_id"), F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).cast("long").alias("n_lines"),
        F.when(F.col("g.gone").isNull(), 0).otherwise(F.size("g.gone")).cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(_kept(text_col), F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
with texts as (select distinct doc_id, text, string_split(text, chr(10)) as lines from documents where text is not null),
cut as (
  select doc_id, text, n as line_no, lines[n + 1] as line,
         case when n = 0 then '^' else ':' || substring(lines[n], 1, {NEAR}) end as before,
         case when n + 1 = len(lines) then '$' else ':' || substring(lines[n + 2], 1, {NEAR}) end as after
  from (select *, unnest(range(len(lines))) as n from texts)),
worded as (
  select * exclude (line), list_filter(string_split_regex(regexp_replace(line, '{MASKED}', '<*>', 'g'), '{GAPS}'), lambda x: x <> '') as words from cut),
parsed as (
  select doc_id, text, line_no, before, after, len(words) || ' ' || array_to_string(words[1:{DEPTH}], ' ') as leaf, array_to_string(words, ' ') as line,
         words[{DEPTH + 1}:] as rest, ceil((len(words) - {DEPTH}) / {FIELDS})::int as width
  from worded where len(words) > 0),
lines as (
  select * exclude (rest, width), case when len(rest) = 0 then [] else
         list_transform(range(ceil(len(rest) / width)::int), lambda i: array_to_string(rest[i * width + 1:(i + 1) * width], ' ')) end as fields
  from parsed),
n_leaf as (select leaf from lines group by leaf having count(*) >= {MIN_DOCS}),
busy as (select * from lines semi join n_leaf using (leaf)),
variants as (select leaf, line, count(*) as n, any_value(fields) as fields from busy group by all),
mixed as (select leaf from variants group by leaf having count(*) > 1 and sum(n) >= {SUPPORT}),
places as (
  select leaf, line, n, p as place, fields[p] as field
  from (select *, unnest(range(1, len(fields) + 1)) as p from variants semi join mixed using (leaf))),
support as (select leaf, place, field, sum(n) >= {SUPPORT} as constant from places group by all),
drawn as (
  select leaf, line, list(case when constant then field else '<*>' end order by place) as drawn,
         (count(*) filter (where constant) + {DEPTH}) / (count(*) + {DEPTH}) as alike
  from places join support using (leaf, place, field) group by all),
named as (
  select b.*, coalesce(leaf || ' ' || array_to_string(d.drawn, '|'), '= ' || b.line) as template
  from busy b left join (select * from drawn where alike >= {SIMILARITY}) d using (leaf, line)),
boiler as (
  select template from named group by template
  having count(distinct (doc_id, text)) >= {MIN_DOCS} and count(distinct (before, after)) >= {MIN_DOCS}
     and count(distinct (before, after)) >= count(distinct (doc_id, text)) * {APART}),
gone as (select doc_id, text, list(distinct line_no) as gone from named semi join boiler using (template) group by all)
select d.doc_id, case when d.text is null then 0 else len(string_split(d.text, chr(10))) end::bigint as n_lines,
       coalesce(len(gone), 0)::bigint as n_dropped,
       sha256(case when gone is null then coalesce(d.text, '') else array_to_string(
         list_transform(list_filter(range(len(string_split(d.text, chr(10)))), lambda i: not list_contains(gone, i)),
                        lambda i: string_split(d.text, chr(10))[i + 1]), chr(10)) end) as kept_sha256
from documents d left join gone g on d.doc_id is not distinct from g.doc_id and d.text = g.text
"""
