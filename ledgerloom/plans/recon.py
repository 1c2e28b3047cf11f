"""Reconciliation between the core system, the live feed, file dumps and statements."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.functions.payload import computed_once, parse_payload
from ledgerloom.operators.dedupe import drop_exact_duplicates, latest_per_key, pick_per_key
from ledgerloom.operators.joins import missing_from, rule_agreement

# Product codes → days, and the part of the principal paid out per term.
TERM_DAYS = {"10001": 1, "10002": 7, "10003": 21}
PAID_OUT = {"1": 99.52, "7": 96.88, "21": 90.88}
FEED_TIME = "yyyyMMddHHmmss"


def feed_rows(log: DataFrame, menu: str, schema: str) -> DataFrame:
    """Requests of one kind from the request log, payload opened."""
    good, _ = parse_payload(log.filter(F.col("menu") == menu), "raw_request", schema)
    return good.select("log_id", "status_code", "request_time", "payload.*")


def feed_missing(feed: DataFrame, core: DataFrame, already: DataFrame, key: str, columns: dict, time: str) -> DataFrame:
    """Feed rows that neither the core system nor an earlier reconciliation
    holds: one per key and status, the newest request counts."""
    rows = feed.filter(F.col(key).isNotNull())
    rows = missing_from(rows, (core, key, "receipt_number"), (already, key, "receipt_number"))
    one = pick_per_key(rows, [key, "status_code"], ["request_time", "log_id"])
    return one.select(*[F.col(src).alias(dst) for dst, src in columns.items()], "status_code",
                      F.try_to_timestamp(F.col(time), F.lit(FEED_TIME)).alias("initiated_at"), F.lit("feed").alias("src"))


def contract_match(transactions: DataFrame, contracts: DataFrame) -> DataFrame:
    """Completed disbursements with their contract: same contract id, and the
    amount equals the principal with or without the fee. The id keeps it an
    equality join; the amounts only filter the matches."""
    amount = F.col("amount")
    near = (amount == F.col("principal")) | (amount - F.col("fee") == F.col("principal"))
    c = contracts.select("contract_id", "principal", "access_fee", "product_code", "identity")
    t = transactions.filter("is_disbursement and status = 'Completed'")
    return t.join(c, (F.col("loan_contract_id") == F.col("contract_id")) & near).filter("principal is not null").distinct()


def dump_disbursements(transactions: DataFrame, contracts: DataFrame, already: DataFrame) -> DataFrame:
    """Disbursements of the dumps that were not shared before."""
    fresh = missing_from(contract_match(transactions, contracts), (already, "surrogate_id", "warehouse_key"))
    info = text.drop_special_characters(F.concat(F.col("store_number"), F.lit(" - "), F.col("party_name")))
    return fresh.select(
        F.col("surrogate_id").alias("warehouse_key"), F.col("linked_id").alias("receipt_number"),
        F.col("file_day").alias("initiated_on"), F.col("principal").alias("loan_principal"), info.alias("other_party"),
        "store_number", text.map_codes(F.col("product_code"), TERM_DAYS).alias("loan_term"), F.lit("dump").alias("src"))


def dump_repayments(transactions: DataFrame, contracts: DataFrame, already: DataFrame) -> DataFrame:
    """Completed repayments, copies removed, not shared before, with the receipt
    of the disbursement they belong to (same contract and identity)."""
    paid = latest_per_key(transactions.filter("is_repayment and status = 'Completed'"),
                          ["transaction_id", "linked_id"], F.col("surrogate_id"))
    paid = missing_from(paid, (already, "surrogate_id", "warehouse_key"))
    given = contract_match(transactions, contracts).filter("identity = owner_id").groupBy("contract_id", "identity").agg(
        F.min(F.trim("linked_id")).alias("loan_ref"))
    joined = paid.join(given, (F.col("loan_contract_id") == F.col("contract_id")) & (F.col("owner_id") == F.col("identity")), "left")
    return joined.select(F.col("surrogate_id").alias("warehouse_key"), "loan_ref", F.trim("linked_id").alias("receipt_number"),
                         F.col("file_day").alias("initiated_on"), F.col("amount").alias("paid_in"), "store_number",
                         F.lit("dump").alias("src"))


def dump_opt_ins(activity: DataFrame, already: DataFrame) -> DataFrame:
    """Latest usable opt-in per shop that was not shared before."""
    usable = activity.filter(
        F.col("opt_in_date").isNotNull() & F.col("store_number").isNotNull() & (F.trim("store_number") != "-1")
        & F.col("customer_name").isNotNull() & (F.col("id_number").isNotNull() | F.col("identity").isNotNull()))
    one = latest_per_key(usable, "store_number", [F.col("opt_in_date").desc(), F.col("surrogate_id").desc()])
    return missing_from(one, (already, "surrogate_id", "warehouse_key")).select(
        F.col("surrogate_id").alias("warehouse_key"), "store_number",
        text.drop_special_characters(F.trim("entity_name")).alias("first_name"),
        text.drop_special_characters(F.trim("customer_name")).alias("business_name"),
        F.coalesce("id_number", F.trim("identity")).alias("national_id"),
        text.strip_decimal_suffix(F.col("phone")).alias("phone"), F.col("opt_in_date").alias("registered_on"))


def statement_disbursements(statement: DataFrame, already: DataFrame, since) -> DataFrame:
    """Disbursements on statements that were not shared before. The statement
    shows what was paid out; the principal is that grossed up by its term."""
    rows = statement.filter((F.col("transaction_status") == "Completed") & F.col("details").like("%Disbursement%")
                            & (F.col("completed_at") > F.lit(since).cast("timestamp_ntz")))
    rows = computed_once(
        rows, loan_term=F.split_part("reason_type", F.lit(" "), F.lit(1)),
        store_number=F.nullif(F.regexp_extract("details", r"\w+(?=\s*-\s*)", 0), F.lit("")))
    rows = rows.filter(~F.col("loan_term").rlike("^[A-Za-z]+$") & F.col("store_number").isNotNull())
    term = F.col("loan_term")
    gross = F.when(F.lit(False), F.lit(0.0))
    for days, percent in PAID_OUT.items():
        gross = gross.when(term == days, F.col("withdrawn") * -1 * 100 / F.lit(percent))
    out = rows.select(
        F.col("statement_id").alias("warehouse_key"), "receipt_number", gross.otherwise(F.col("withdrawn")).alias("loan_principal"),
        "other_party", "store_number", "loan_term")
    return missing_from(out, (already, "warehouse_key", "warehouse_key"))


def statement_repayments(statement: DataFrame, transactions: DataFrame, loans: DataFrame, already: DataFrame) -> DataFrame:
    """Repayments on statements whose receipt the dumps and the core know."""
    first = latest_per_key(transactions.filter("is_repayment"), "linked_id", F.col("surrogate_id")).filter("status = 'Completed'")
    rows = statement.filter("is_repayment and transaction_status = 'Completed'")
    linked = rows.join(first.select("linked_id", "loan_contract_id"), F.col("receipt_number") == F.col("linked_id"))
    linked = linked.join(loans.select(F.col("contract_id").alias("loan_contract_id"), F.col("receipt_number").alias("loan_ref")),
                         "loan_contract_id")
    fresh = missing_from(linked, (already, "statement_id", "warehouse_key"))
    shop = F.trim(F.split_part("other_party", F.lit("-"), F.lit(1))).try_cast("long")
    one = pick_per_key(fresh.withColumn("store_number", shop).select(
        "receipt_number", "statement_id", "loan_ref", "paid_in", "store_number"), ["receipt_number"], ["statement_id"])
    return one.withColumnRenamed("statement_id", "warehouse_key")


def contract_check(transactions: DataFrame, contracts: DataFrame) -> DataFrame:
    """Does the contract id on a disbursement agree with the one found from
    identity, date and amount?"""
    t = transactions.filter("is_disbursement and status like '%Completed%'")
    payload = [c for c in t.columns if c != "surrogate_id"]
    t = drop_exact_duplicates(t, payload, ["surrogate_id"], ties="one", largest=False)
    c = latest_per_key(contracts, ["id_date", "contract_id", "identity"], F.col("surrogate_id")).select(
        "contract_id", "identity", "id_date", "principal", "access_fee")
    given = t.join(c, (F.col("loan_contract_id") == F.col("contract_id")) & (F.col("owner_id") == F.col("identity"))
                   & (F.col("access_fee") == F.col("fee")), "left").select("linked_id", "contract_id")
    # Derived keys make the date and amount rule an equality join as well.
    c2 = c.withColumns({"_day": F.col("id_date"), "_amount": F.col("principal") + F.col("access_fee")})
    derived = t.withColumns({"_tday": F.date_format("file_day", "yyyyMMdd")}).join(
        c2, (F.col("owner_id") == F.col("identity")) & (F.col("_tday") == F.col("_day")) & (F.col("amount") == F.col("_amount")), "left")
    return rule_agreement(given, derived.select("linked_id", "contract_id"), "linked_id", "contract_id")


def closed_differences(closed: DataFrame, loans: DataFrame, as_of) -> DataFrame:
    """Contracts closed at the partner but active in the core, with what is
    missing or too much per kind of charge."""
    from ledgerloom.operators.aggregate import signed_differences

    fees = ("access_fee", "interest_fee", "maintenance_fee", "rollover_fee", "penalty_fee")
    everything = sum((F.col(c) for c in fees), F.col("principal"))
    totals = closed.groupBy("contract_id").agg(
        F.sum(everything).alias("repaid_theirs"), F.sum("access_fee").alias("interest_theirs"),
        F.sum("penalty_fee").alias("penalty_theirs"), F.sum("rollover_fee").alias("rollover_theirs"),
        F.max("closed_on").alias("closed_on"), F.max(F.struct("created_on", "product_name")).alias("_p"))
    name = F.col("_p.product_name")
    days = F.when(name.contains("-"), F.element_at(F.split(F.split_part(name, F.lit("-"), F.lit(1)), " "), -1)).otherwise(
        F.split_part(name, F.lit(" "), F.lit(2))).try_cast("int")
    out = totals.join(loans.filter("loan_status = 300"), "contract_id")
    out = signed_differences(out, {"repayment": ("repaid_theirs", "repaid"), "penalty": ("penalty_theirs", "penalty"),
                                   "interest": ("interest_theirs", "interest"), "rollover": ("rollover_theirs", "fees")})
    late = F.datediff(F.lit(as_of), "matures_on")
    return out.withColumns({
        "days_late_theirs": F.datediff(F.lit(as_of), F.date_add(F.col("_p.created_on"), days)).cast("long"),
        "days_late_ours": F.greatest(late, F.lit(0)).cast("long")}).drop("_p")


def settled_at_partner(loans: DataFrame) -> DataFrame:
    """Active loans that the partner holds as settled while the core still has principal open."""
    return loans.filter("loan_status = 300 and partner_balance = 0 and principal_outstanding > 0")


def balance_discrepancies(loans: DataFrame, repayments: DataFrame) -> DataFrame:
    """Active loans whose partner balance is not below the core balance although
    the core has a repayment after the partner's balance date."""
    latest = repayments.groupBy("loan_id").agg(F.max("paid_on").alias("latest_repayment"))
    return loans.filter("loan_status = 300 and partner_balance is not null and partner_balance <> 0").join(latest, "loan_id").filter(
        (F.col("partner_balance") >= F.col("total_outstanding")) & (F.col("partner_balance_date") < F.col("latest_repayment"))
    ).withColumns({"variance": F.col("partner_balance") - F.col("total_outstanding"),
                   "days_between": F.datediff("latest_repayment", "partner_balance_date").cast("long")})


def feedback(dump: DataFrame, postings: DataFrame, key: str) -> DataFrame:
    """Best posting status per key, written back to the dump rows that have no
    status, or a failure without a reason."""
    from ledgerloom.operators.dedupe import pick_per_key as pick

    ranked = postings.filter("warehouse_key is not null").withColumn("_order", F.coalesce("status_code", F.lit("9")))
    best = pick(ranked.select(key, "_order", "status_code", "failure_reason"), [key], ["_order", "failure_reason"], largest=False)
    best = best.select(F.col(key).alias("_k"), F.col("status_code").alias("_s"), F.col("failure_reason").alias("_r"))
    pending = F.col("status_code").isNull() | (F.col("failure_reason").isNull() & (F.col("status_code") != "200"))
    return dump.join(best, F.col(key) == F.col("_k"), "left").withColumns({
        "status_code": F.when(pending, F.coalesce("_s", "status_code")).otherwise(F.col("status_code")),
        "failure_reason": F.when(pending, F.coalesce("_r", "failure_reason")).otherwise(F.col("failure_reason")),
    }).drop("_k", "_s", "_r")
