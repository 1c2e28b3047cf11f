"""Snapshot merges: every update is (current, incoming) → next snapshot."""
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.dedupe import pick_per_key
from ledgerloom.operators.joins import null_safe


def new_keys(incoming: DataFrame, current: DataFrame, key: str, current_key: str | None = None,
             trimmed: bool = False) -> DataFrame:
    """Incoming rows whose key the current table does not hold."""
    mine = F.trim(F.col(key)) if trimmed else F.col(key)
    theirs = F.col(current_key or key)
    known = current.select((F.trim(theirs) if trimmed else theirs).alias("_known")).filter("_known is not null").distinct()
    return incoming.join(known, mine == F.col("_known"), "left_anti")


def keep_known(df: DataFrame, known: DataFrame, key: str, known_key: str | None = None, trimmed: bool = False) -> DataFrame:
    """Rows whose key the other table holds (foreign key check)."""
    mine = F.trim(F.col(key)) if trimmed else F.col(key)
    theirs = F.col(known_key or key)
    keys = known.select((F.trim(theirs) if trimmed else theirs).alias("_known")).filter("_known is not null").distinct()
    return df.join(keys, mine == F.col("_known"), "left_semi")


def upsert(current: DataFrame, incoming: DataFrame, keys: list, newest_by: list) -> DataFrame:
    """Current rows with no incoming row, plus one incoming row per key."""
    fresh = pick_per_key(incoming, keys, newest_by).select(current.columns)
    ids = incoming.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    kept = current.join(ids, null_safe(keys, [f"_k_{k}" for k in keys]), "left_anti")
    return kept.unionByName(fresh)


def replace_except(current: DataFrame, incoming: DataFrame, key: str, keep: list) -> DataFrame:
    """Overwrite the table but for the listed ids."""
    return current.filter(F.col(key).isin(keep)).unionByName(incoming)


def _differs(columns: list, a: str = "", b: str = "_n_") -> Column:
    return reduce(lambda x, y: x | y, [~F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}")) for c in columns])


def scd2_merge(current: DataFrame, incoming: DataFrame, keys: list, tracked: list, as_of, carried: tuple = (),
               surrogate: str | None = None, tenant: str = "") -> DataFrame:
    """Versioned merge. ``current`` holds keys, tracked columns, ``valid_from``,
    ``valid_to`` and ``is_current``; ``incoming`` one row per key.

    Unchanged rows stay, changed rows expire at ``as_of`` and get a new version,
    unseen keys are added. Keys missing from ``incoming`` stay current. Only
    current versions take part in the join; history passes straight through.
    ``carried`` columns are no reason for a version: a current row without a
    value takes the incoming one in place. ``surrogate`` names the version key
    of ``current``; new versions get one of their own (``surrogate_key``).
    """
    values = [*tracked, *carried]
    own = [surrogate] if surrogate else []
    columns = [*keys, *values, "valid_from", "valid_to", "is_current", *own]
    at = F.lit(as_of).cast(current.schema["valid_from"].dataType)
    live, history = current.filter("is_current").select(columns), current.filter("not is_current").select(columns)
    arriving = incoming.select(*[F.col(k).alias(f"_n_{k}") for k in keys],
                               *[F.col(c).alias(f"_n_{c}") for c in values], F.lit(True).alias("_n"))
    pair = live.withColumn("_c", F.lit(True)).join(arriving, null_safe(keys, [f"_n_{k}" for k in keys]), "full")
    changed = F.col("_c").isNotNull() & F.col("_n").isNotNull() & _differs(tracked)
    fresh = F.col("_c").isNull() | changed
    filled = [F.when(changed, F.col(c)).otherwise(F.coalesce(c, f"_n_{c}")).alias(c) for c in carried]
    old = F.struct(*[F.col(c).alias(c) for c in [*keys, *tracked]], *filled, F.col("valid_from").alias("valid_from"),
                   F.when(changed, at).otherwise(F.col("valid_to")).alias("valid_to"),
                   (~changed).alias("is_current"), *own)
    new_key = [F.xxhash64(F.lit(tenant), *[F.col(f"_n_{k}") for k in keys], at).alias(surrogate)] if surrogate else []
    new = F.struct(*[F.col(f"_n_{c}").alias(c) for c in [*keys, *values]], at.alias("valid_from"),
                   F.lit(None).cast(at_type(current)).alias("valid_to"), F.lit(True).alias("is_current"), *new_key)
    # One pass: each joined pair yields its old row, its new row, or both.
    rows = F.when(F.col("_c").isNotNull() & fresh, F.array(old, new)).when(fresh, F.array(new)).otherwise(F.array(old))
    return pair.select(F.inline(rows)).select(columns).unionByName(history)


def at_type(current: DataFrame):
    return current.schema["valid_to"].dataType


def surrogate_key(tenant: Column, keys: list, valid_from: str = "valid_from") -> Column:
    """Same version, same key, whatever the run; no sequence needed."""
    return F.xxhash64(tenant, *[F.col(k) for k in keys], F.col(valid_from))


def repoint(facts: DataFrame, versions: DataFrame, keys: list, surrogate: str, fact_key: str, since) -> DataFrame:
    """Facts whose dimension version expired at ``since`` or later follow to the newest version of the same key.

    However many versions came in between, a fact goes to the last one in a
    single join; facts of versions that expired earlier, or that the dimension
    does not hold, stay. The remap has one row per expired version, so a
    version that most facts have can be split.
    """
    newest = versions.groupBy(*keys).agg(F.max_by(surrogate, "valid_from").alias("_new"))
    expired = versions.filter(~F.col("is_current") & (F.col("valid_to") >= F.lit(since).cast(versions.schema["valid_to"].dataType)))
    remap = expired.select(*[F.col(k).alias(f"_e_{k}") for k in keys], F.col(surrogate).alias("_old")).join(
        newest, null_safe([f"_e_{k}" for k in keys], keys)).select("_old", "_new")
    moved = facts.join(remap, F.col(fact_key) == F.col("_old"), "left")
    return moved.withColumn(fact_key, F.coalesce("_new", fact_key)).select(facts.columns)


def frame_diff(incoming: DataFrame, current: DataFrame, columns: list) -> DataFrame:
    """Incoming rows with no equal row in the current table; nulls are equal.

    Same as keeping the left-only rows of an outer merge on all columns:
    repeated incoming rows stay repeated.
    """
    known = current.select(*[F.col(c).alias(f"_k_{c}") for c in columns]).distinct()
    return incoming.select(columns).join(known, null_safe(columns, [f"_k_{c}" for c in columns]), "left_anti")


def sync(current: DataFrame, incoming: DataFrame, key: str, columns: list) -> DataFrame:
    """Each incoming row marked 'insert' (unseen key) or 'update' (seen, differs). Of current rows that repeat a key the largest counts."""
    rest = [c for c in columns if c != key]
    known = pick_per_key(current.select(F.trim(F.col(key)).alias("_k"), *[F.col(c).alias(f"_n_{c}") for c in rest]), ["_k"], [f"_n_{c}" for c in rest])
    joined = incoming.select(columns).join(known, F.trim(F.col(key)) == F.col("_k"), "left")
    action = F.when(F.col("_k").isNull(), F.lit("insert")).when(_differs(rest), F.lit("update"))
    return joined.withColumn("action", action).filter("action is not null").select(*columns, "action")


def audit_changes(before: DataFrame, after: DataFrame, key: str, columns: list, source: str, at) -> DataFrame:
    """One row per changed value: key, column, old, new, local time, source."""
    pairs = before.select(key, *[F.col(c).cast("string").alias(c) for c in columns]).join(
        after.select(key, *[F.col(c).cast("string").alias(f"_n_{c}") for c in columns]), key)
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("previous_value"), F.col(f"_n_{c}").alias("current_value"))
        for c in columns])
    return (
        pairs.select(key, F.inline(entries))
        .filter(~F.col("previous_value").eqNullSafe(F.col("current_value")))
        .withColumn("updated_at", F.from_utc_timestamp(F.lit(at).cast("timestamp"), "Africa/Nairobi"))
        .withColumn("source", F.lit(source))
    )


def fill_missing(target: DataFrame, source: DataFrame, key: str, columns: list, prefer: str = "target") -> DataFrame:
    """Fill nulls of the target from the source, or let the source win. Of source rows that repeat a key the largest counts."""
    src = pick_per_key(source.select(key, *[F.col(c).alias(f"_s_{c}") for c in columns]), [key], [f"_s_{c}" for c in columns])
    out = target.join(src, key, "left")
    for c in columns:
        pair = (c, f"_s_{c}") if prefer == "target" else (f"_s_{c}", c)
        out = out.withColumn(c, F.coalesce(*pair))
    return out.select(target.columns)


def drop_reversed(target: DataFrame, incoming: DataFrame, reversed_rows: DataFrame, key: str) -> tuple:
    """(target, incoming) without the reversed transactions."""
    gone = reversed_rows.select(F.col(key).alias("_gone")).filter("_gone is not null").distinct()
    strip = lambda df: df.join(gone, F.col(key) == F.col("_gone"), "left_anti")
    return strip(target), strip(incoming)


def apply_corrections(target: DataFrame, corrections: DataFrame, key: str, columns: list, source: str, at) -> tuple:
    """(target with the corrected values, log of every changed value)."""
    after = fill_missing(target, corrections, key, columns, prefer="source")
    return after, audit_changes(target, after, key, columns, source, at)
