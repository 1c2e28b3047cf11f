"""Extracts that build the warehouse tables, parameterised by tenant."""
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.functions.dates import month_window
from ledgerloom.operators import joins, merge
from ledgerloom.operators.dedupe import pick_per_key

# Transaction and loan status codes of the core system.
DISBURSEMENT, REPAYMENT = 1, 2
ACTIVE, CLOSED, OVERPAID = 300, 600, 700


@dataclass(frozen=True)
class Tenant:
    """What differs between two partners that share one warehouse layout."""
    name: str
    office_id: int
    version: str | None = None
    payment_required: bool = False
    transaction_types: tuple = (DISBURSEMENT, REPAYMENT)
    flags: tuple = field(default_factory=tuple)


def flag(column: str, unset_means: bool = False):
    """0/1 → boolean. A null is false, or true where only an explicit 0 is false."""
    c = F.col(column)
    return F.coalesce(c != 0, F.lit(True)) if unset_means else F.coalesce(c == 1, F.lit(False))


def dimension(source: DataFrame, current: DataFrame, key: str, renames: dict, booleans: tuple = ()) -> DataFrame:
    """New rows of a dimension: unseen ids only, flags as booleans, new names."""
    fresh = merge.new_keys(source, current, key, renames.get(key, key))
    return fresh.withColumns({b: flag(b) for b in booleans}).withColumnsRenamed(renames) if booleans else (
        fresh.withColumnsRenamed(renames))


def clients(source: DataFrame, codes: DataFrame, statuses: DataFrame, current: DataFrame) -> DataFrame:
    """New clients with gender, type and status as text.

    A client without a status text is left out; missing gender or type is not a
    reason to leave a client out.
    """
    gender = codes.select(F.col("id").alias("gender_id"), F.col("code_value").alias("gender"))
    kind = codes.select(F.col("id").alias("client_type_id"), F.col("code_value").alias("client_type"))
    status = statuses.filter("enum_name = 'status_enum'").select(
        F.col("enum_id").alias("status_enum"), F.col("enum_value").alias("status"))
    full = source.join(gender, "gender_id", "left").join(kind, "client_type_id", "left").join(status, "status_enum")
    return pick_per_key(merge.new_keys(full, current, "id", "core_id"), ["id"], ["status"])


def transactions(tenant: Tenant, loans: DataFrame, txns: DataFrame, payments: DataFrame, kinds: DataFrame,
                 is_reversed: bool, first=None, last=None) -> DataFrame:
    """Loan transactions of one office with their payment details."""
    wanted = txns.filter(F.col("transaction_type").isin(*tenant.transaction_types)
                         & (F.col("is_reversed") == int(is_reversed)) & (F.col("office_id") == tenant.office_id))
    if first is not None:
        wanted = wanted.filter(F.col("transaction_date").between(F.lit(first), F.lit(last)))
    detail = payments.join(kinds, "payment_type_id", "left")
    out = wanted.join(loans.select("loan_id"), "loan_id").join(
        detail, "payment_id", "inner" if tenant.payment_required else "left")
    return out.withColumn("version", F.lit(tenant.version)) if tenant.version else out


def transactions_of_month(tenant: Tenant, loans, txns, payments, kinds, year: int, month: int) -> tuple:
    """(valid, reversed) transactions of one calendar month."""
    first, last = month_window(year, month)
    return tuple(transactions(tenant, loans, txns, payments, kinds, r, first, last) for r in (False, True))


def load_transactions(target: DataFrame, incoming: DataFrame, reversed_rows: DataFrame, text_columns: list,
                      keys: list, newest_by: list) -> DataFrame:
    """Next snapshot of the transaction table: reversed rows go from both sides,
    blanks become null, direction flags come from the type, then an upsert."""
    target, incoming = merge.drop_reversed(target, incoming, reversed_rows, keys[-1])
    kind = F.col("transaction_type")
    ready = incoming.withColumns({c: F.when(F.col(c).rlike(r"^\s*$"), F.lit(None)).otherwise(F.col(c)) for c in text_columns})
    ready = ready.withColumns({
        "is_repayment": F.when(kind == REPAYMENT, True).when(kind == DISBURSEMENT, False),
        "is_disbursement": F.when(kind == DISBURSEMENT, True).when(kind == REPAYMENT, False),
        "is_reversed": F.col("is_reversed") == 1,
    })
    return merge.upsert(target, ready, keys, newest_by)


# Looked-up codes and flags of a core loan.
ENUMS = ("loan_type", "transaction_strategy", "term_frequency")
FLAGS = ("is_npa", "accounting_recognised", "sync_with_meeting", "variable_instalments")


def resolve_keys(loans: DataFrame, clients: DataFrame, products: DataFrame, statuses: DataFrame,
                 officers: DataFrame, enums: DataFrame) -> DataFrame:
    """Surrogate keys for the loan fact. Client and product must be known,
    status and officer may be missing. Enum ids become their text, flags booleans
    (0 is false, anything else true), where the loans have them."""
    out = (
        loans.join(clients.select(F.col("core_id").alias("client_id"), F.col("surrogate_id").alias("client_key")), "client_id")
        .join(products.select(F.col("core_id").alias("product_id"), F.col("surrogate_id").alias("product_key")), "product_id")
        .join(statuses.select(F.col("core_id").alias("loan_status"), F.col("surrogate_id").alias("status_key")), "loan_status", "left")
        .join(officers.select(F.col("core_id").alias("officer_id"), F.col("surrogate_id").alias("officer_key")), "officer_id", "left")
    )
    for name in (n for n in ENUMS if f"{n}_id" in loans.columns):
        values = enums.filter(F.col("enum_name") == name).select(F.col("enum_id").alias(f"{name}_id"), F.col("enum_value").alias(name))
        out = out.join(values, f"{name}_id", "left")
    return out.withColumns({f: F.col(f) != 0 for f in FLAGS if f in loans.columns})


def with_model_version(loans: DataFrame, known: DataFrame, versions: DataFrame) -> DataFrame:
    """Model version of each loan: the one it already has, else the latest whose
    end date lies before the disbursement."""
    have = known.groupBy("loan_id").agg(F.max("model_version").alias("_known"))
    found = joins.asof_join(loans, versions, "disbursed_on", "end_date", "model_version", strict=True)
    return found.join(have, "loan_id", "left").withColumn(
        "model_version", F.coalesce("_known", "model_version")).drop("_known")


def map_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """target name → source name; a missing source column becomes null text."""
    return df.select([
        (F.col(src) if src in df.columns else F.lit(None).cast("string")).alias(dst) for dst, src in mapping.items()])


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def child_rows(df: DataFrame, key: str, column: str, item_schema: str, fields: list) -> DataFrame:
    """Rows of a JSON array held in a text column; blank text has no rows."""
    items = F.from_json(F.trim(F.col(column)), f"array<struct<{item_schema}>>")
    return df.select(key, F.explode(items).alias("_item")).select(key, *[F.col(f"_item.{f}").alias(f) for f in fields])


def new_children(df: DataFrame, key: str, column: str, item_schema: str, fields: list, known: DataFrame,
                 known_key: str) -> DataFrame:
    return merge.new_keys(child_rows(df, key, column, item_schema, fields), known, fields[0], known_key)


# Rejection codes, and loan ids that mean "no loan".
REJECTIONS = {"1001": "Duplicate", "1002": "Any other reason", "1003": "Requested more than limit"}
NO_LOAN = ("NOT POSTED", "REJECTED", "")


def deliveries(offers: DataFrame, known: DataFrame, stalls: DataFrame, as_of) -> DataFrame:
    """Expired offers of known stalls that are not stored yet."""
    fresh = merge.keep_known(
        merge.new_keys(offers.filter(F.col("offer_expiry") < F.lit(as_of)), known, "delivery_id"), stalls, "stall_id")
    reason = F.col("rejection_reason")
    return fresh.withColumns({
        "rejection_reason": text.map_codes(reason, REJECTIONS, reason),
        "loan_id": text.null_tokens(F.trim("loan_id"), NO_LOAN),
        "offer_response": F.get_json_object("offer_response", "$.status_code"),
    })


def answers_to_columns(answers: DataFrame, entity: str, question: str, answer: str, order: str, names: dict) -> DataFrame:
    """One row per entity, one column per question; the first answer counts."""
    return answers.filter(F.col(question).isin(*names)).groupBy(entity).agg(
        *[F.min_by(F.col(answer), F.when((F.col(question) == q) & F.col(answer).isNotNull(), F.col(order))).alias(n)
          for q, n in names.items()])


def suspension_changes(events: DataFrame, current: DataFrame) -> DataFrame:
    """Suspensions and releases newer than what is stored for the shop.

    ``events``: shop, start_date (suspended) or end_date (released), and the
    flag. A stored date on or before the new one blocks the row.
    """
    stored = current.select(F.col("shop").alias("_shop"), F.col("is_suspended").alias("_flag"),
                            F.col("start_date").alias("_start"), F.col("end_date").alias("_end"))
    pair = events.join(stored, (F.col("shop") == F.col("_shop")) & (F.col("is_suspended") == F.col("_flag")), "left")
    blocked = F.when(F.col("is_suspended"), F.col("_start") <= F.col("start_date")).otherwise(F.col("_end") <= F.col("end_date"))
    return pair.filter(~F.coalesce(blocked, F.lit(False))).select(events.columns).distinct()


def expire_suspensions(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Stored suspensions with the day on which a later change of the shop ended
    them (``expired_on``), null while nothing followed."""
    day = F.coalesce("start_date", "end_date")
    later = changes.select(F.col("shop").alias("_shop"), day.alias("_day")).groupBy("_shop").agg(F.array_sort(F.collect_set("_day")).alias("_days"))
    first = F.get(F.filter("_days", lambda x: x > day), F.lit(0))
    return current.join(later, F.col("shop") == F.col("_shop"), "left").withColumn("expired_on", first).drop("_shop", "_days")


def loan_charges(charges: DataFrame, loans: DataFrame) -> DataFrame:
    """All charges, with the client of their loan where the loan is known. A loan id that repeats counts once."""
    return charges.join(loans.groupBy("loan_id").agg(F.max("client_id").alias("client_id")), "loan_id", "left")


def officer_history(assignments: DataFrame, current: DataFrame) -> DataFrame:
    """Unseen assignments of officers to loans, under their warehouse names; an open assignment has no end."""
    return dimension(assignments, current, "id", {"id": "core_id", "loan_officer_id": "officer_id", "start_date": "assigned_on", "end_date": "released_on"})


def company_lists(names: DataFrame, known: DataFrame, column: str, flags: dict) -> DataFrame:
    """New names only, with the literal flags of the list they come from."""
    trimmed = names.select(F.trim(F.col(column)).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return merge.new_keys(trimmed, known, column, trimmed=True).withColumns({k: F.lit(v) for k, v in flags.items()})


def exchange_rates(rates: DataFrame, currencies: DataFrame) -> DataFrame:
    """One row per base and quoted currency, both as keys; unknown codes go."""
    keys = currencies.select(F.col("code").alias("_code"), F.col("currency_id").alias("_id"))
    long = rates.select("base", "date", F.explode("rates").alias("code", "rate"))
    return (
        long.join(keys, F.col("base") == F.col("_code")).withColumnRenamed("_id", "base_id").drop("_code")
        .join(keys, F.col("code") == F.col("_code")).withColumnRenamed("_id", "code_id").drop("_code")
        .dropna()
    )


def collections_entity(rows: DataFrame, current: DataFrame, key: str, parents: list) -> DataFrame:
    """New rows whose parents all exist; parents are (frame, own key, parent key)."""
    out = merge.new_keys(rows, current, key)
    for parent, mine, theirs in parents:
        out = merge.keep_known(out, parent, mine, theirs)
    return out.dropDuplicates()


def contact_statuses(statuses: DataFrame, types: DataFrame, current: DataFrame) -> DataFrame:
    """New contact statuses with the title of their type, if it has one."""
    titles = types.select(F.col("id").alias("contact_type_id"), F.col("title").alias("contact_type"))
    named = statuses.join(titles, "contact_type_id", "left")
    return collections_entity(named.select(F.col("id").alias("core_id"), "title", "description", "contact_type"), current, "core_id", [])


def drop_unknown(current: DataFrame, core: DataFrame, key: str, core_key: str, where: Column) -> DataFrame:
    """The table without rows of a kind (``where``) that the core system does not have; other rows are not looked at."""
    kind = F.coalesce(where, F.lit(False))
    known = merge.keep_known(current.filter(kind), core, key, core_key)
    return known.unionByName(current.filter(~kind))


def correct_keys(facts: DataFrame, core: DataFrame, key: str, column: str) -> DataFrame:
    """Facts with the core system's value where it differs from the stored one."""
    truth = core.select(key, F.col(column).alias("_truth"))
    return facts.join(truth, key, "left").withColumn(
        "corrected", ~F.col(column).eqNullSafe(F.coalesce("_truth", F.col(column)))).withColumn(
        column, F.coalesce("_truth", F.col(column))).drop("_truth")


def long_id_replacements(clients: DataFrame, opt_ins: DataFrame, max_length: int = 15) -> DataFrame:
    """Clients whose id is a long number get the short id of their opt-in."""
    short = pick_per_key(opt_ins.filter("national_id is not null"), ["store_number"], ["opt_in_date", "national_id"]).select(
        "store_number", F.col("national_id").alias("_short"))
    is_long = (F.length("national_id") > max_length) & F.col("national_id").rlike("^[0-9]+$")
    return clients.join(short, "store_number", "left").withColumn(
        "national_id", F.when(is_long, F.coalesce("_short", "national_id")).otherwise(F.col("national_id"))).drop("_short")


def whitelist_details(whitelist: DataFrame, clients: DataFrame, suspensions: DataFrame, reasons: DataFrame) -> DataFrame:
    """Whitelist rows with client details, suspension and limit reason. The
    newest product version of a client counts, and the newest reason."""
    from ledgerloom.operators.dedupe import latest_per_key
    who = latest_per_key(clients, "store_number", F.col("version").desc())
    why = latest_per_key(reasons, "store_number", F.col("model_version").desc())
    held = suspensions.filter("is_current").drop("is_current").distinct()
    return whitelist.join(who, "store_number", "left").join(held, "store_number", "left").join(
        why.drop("model_version"), "store_number", "left")
