"""Name similarity and the batches it leads to."""
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query, table
from ledgerloom.functions.similarity import with_token_scores
from ledgerloom.plans import kyc


def _names(spark, d):
    """Opening and closing turns of conversations as names of one id."""
    turns = table(spark, d, "conversations")
    first = turns.select(F.col("conv_id").alias("national_id"), F.col("turn").alias("opt_in_date"), F.lower("text").alias("ops_name"))
    place = F.when(F.col("turn").isNotNull(), F.struct("turn", "text"))  # of two texts of one turn always the same
    own = turns.groupBy("conv_id").agg(F.max_by("text", place).alias("own_name"), F.min_by("text", place).alias("registry_name"))
    return first.join(own, F.col("national_id") == F.col("conv_id")).withColumns({
        "ops_id": F.when(F.col("conv_id") % 3 != 0, F.col("conv_id")), "own_name": F.lower("own_name"), "registry_name": F.lower("registry_name")}).drop("conv_id")


def _scores_sql(asked: str) -> str:
    """Token-set scores of the distinct pairs (a, b) of ``asked``; letter by letter, where the first common subsequence of each length ends."""
    words = "list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace({}, '[^\\p{{L}}\\p{{M}}\\p{{N}}_]', ' ', 'g'), ' +'), lambda w: w <> '')))"
    return f"""asked as ({asked}),
split as (select a, b, {words.format("a")} as x, {words.format("b")} as y from asked),
rests as (select a, b, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') as s, array_to_string(list_filter(x, lambda w: not list_contains(y, w)), ' ') as ra,
  array_to_string(list_filter(y, lambda w: not list_contains(x, w)), ' ') as rb from split),
pairs as (select row_number() over () as id, * from (select distinct case when length(ra) < length(rb) then rb else ra end as ra, case when length(ra) < length(rb) then ra else rb end as rb
  from rests where ra <> '' and rb <> '')),
folded as (select id, list_reduce(list_prepend({{'t': [0::bigint], 'c': ''}}, list_transform(string_split(rb, ''), lambda y: {{'t': [0::bigint], 'c': y}})),
  lambda known, e: {{'c': '', 't': list_filter(list_transform(list_zip(list_append(known.t, null),
    list_prepend(null, list_transform(known.t, lambda j: j + coalesce(nullif(strpos(substring(ra, j::int + 1, 40), e.c), 0), nullif(strpos(substring(ra, j::int + 1), e.c), 0))))), lambda p: least(p[1], p[2])), lambda j: j is not null)}}) as r from pairs),
longest as (select id, len(r.t) - 1 as n from folded),
wholes as (select a, b, length(s) as n, trim(s || ' ' || r.ra) as wa, trim(s || ' ' || r.rb) as wb, coalesce(l.n, 0) as c, r.ra <> '' and r.rb <> '' and s <> '' as gap
  from rests r left join pairs p on p.ra = case when length(r.ra) < length(r.rb) then r.rb else r.ra end and p.rb = case when length(r.ra) < length(r.rb) then r.ra else r.rb end
  left join longest l using (id)),
scored as (select a, b, case when wa = '' or wb = '' then 0 else greatest(
    case when n > 0 then round_even(200.0::double * n / (n + length(wa)), 0) else 0 end, case when n > 0 then round_even(200.0::double * n / (n + length(wb)), 0) else 0 end,
    round_even(200.0::double * (n + c + gap::int) / (length(wa) + length(wb)), 0))::int end as score from wholes)"""


_NAMED_SQL = """with recursive turns as (select conv_id, turn, lower("text") as t, "text" as raw from conversations),
own as (select conv_id, arg_max(t, turn) as own_name, arg_min(t, turn) as registry_name from turns group by 1),
names as (select conv_id as national_id, turn as opt_in_date, case when conv_id % 3 <> 0 then conv_id end as ops_id, t as ops_name, own_name, registry_name,
  turn = max(turn) over (partition by conv_id) as newest from turns join own using (conv_id)),
""" + _scores_sql("""select own_name as a, ops_name as b from names union select own_name, registry_name from names union select ops_name, registry_name from names""") + """,
told as (select n.*, x.score as own_ops, y.score as own_registry, z.score as ops_registry from names n
  join scored x on x.a = own_name and x.b = ops_name join scored y on y.a = own_name and y.b = registry_name join scored z on z.a = ops_name and z.b = registry_name)
"""


@query("name_similarity", _NAMED_SQL + "select national_id, opt_in_date, own_ops, own_registry, ops_registry from told")
def name_similarity(spark, d):
    return kyc.name_scores(_names(spark, d)).select("national_id", "opt_in_date", "own_ops", "own_registry", "ops_registry")


@query("kyc_batches", _NAMED_SQL + """,
placed as (select *, case when newest and own_ops < 78 and ops_registry = 100 then 0 when newest and own_ops < 78 and ops_registry > 70 and own_registry <> 100 then 1
    when newest and own_registry <> 100 and ops_id = national_id and ops_registry < 65 then 2 when newest and own_ops < 78 and ops_id = national_id and own_registry = 100 then 3
    when newest and own_ops = 100 and own_registry = 100 and ops_registry = 100 then 4 when newest and own_ops >= 70 and own_registry >= 70 and ops_registry >= 70 then 5
    when newest and own_ops <> 100 and ops_registry = 100 then 6 when own_ops < 65 then 7 end as place from told where not regexp_matches(ops_name, '[0-9]')),
one as (select *, row_number() over (partition by national_id order by place, encode(ops_name)) as r from placed where place is not null)
select national_id, ['update_exact', 'update_close', 'names_swapped', 'keep_id_match', 'keep_all_exact', 'keep_all_close', 'keep_ops_exact', 'consult'][place + 1] as batch,
  own_ops, own_registry, ops_registry from one where r = 1""")
def kyc_batches(spark, d):
    return kyc.triage(_names(spark, d)).select("national_id", "batch", "own_ops", "own_registry", "ops_registry")


@query("kyc_batches_scored", """
with rows as (select conv_id as national_id, turn, text as ops_name, case when conv_id % 3 <> 0 then conv_id end as ops_id,
    least(100, (conv_id * 37 + turn * 11) % 130) as a, least(100, (conv_id * 53 + turn * 7) % 140) as b, least(100, (conv_id * 71 + turn * 29) % 150) as c,
    turn = max(turn) over (partition by conv_id) as newest from conversations),
placed as (select *, case when newest and a < 78 and c = 100 then 0 when newest and a < 78 and c > 70 and b <> 100 then 1
    when newest and b <> 100 and ops_id = national_id and c < 65 then 2 when newest and a < 78 and ops_id = national_id and b = 100 then 3
    when newest and a = 100 and b = 100 and c = 100 then 4 when newest and a >= 70 and b >= 70 and c >= 70 then 5 when newest and a <> 100 and c = 100 then 6
    when a < 65 then 7 end as place from rows where not regexp_matches(ops_name, '[0-9]'))
select national_id, ['update_exact', 'update_close', 'names_swapped', 'keep_id_match', 'keep_all_exact', 'keep_all_close', 'keep_ops_exact', 'consult'][min(place) + 1] as batch
from placed where place is not null group by national_id""")
def kyc_batches_scored(spark, d):
    """The batches on scores that are given."""
    turns = table(spark, d, "conversations")
    score = lambda i, t, m: F.least(F.lit(100), (F.col("conv_id") * i + F.col("turn") * t) % m)
    scored = kyc.named(turns.select(
        F.col("conv_id").alias("national_id"), F.col("turn").alias("opt_in_date"), F.when(F.col("conv_id") % 3 != 0, F.col("conv_id")).alias("ops_id"),
        F.col("text").alias("ops_name"), F.lit("").alias("own_name"), F.lit("").alias("registry_name"),
        score(37, 11, 130).alias("own_ops"), score(53, 7, 140).alias("own_registry"), score(71, 29, 150).alias("ops_registry")))
    return kyc.triage_scored(scored).select("national_id", "batch")


@query("name_similarity_shared", "select p_partkey, cast(100 as bigint) as score from part")
def name_similarity_shared(spark, d):
    """One name's words are all in the other: a full score, whatever follows."""
    names = table(spark, d, "part").select("p_partkey", "p_name", F.concat_ws(" ", F.lower("p_type"), F.upper("p_name")).alias("longer"))
    return with_token_scores(names, {"score": ("p_name", "longer")}).select("p_partkey", F.col("score").cast("long").alias("score"))
