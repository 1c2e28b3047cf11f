"""Loan records for bureau submission, set-based over a whole portfolio."""
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions import text
from ledgerloom.functions.dates import as_date, plausible_birth_date
from ledgerloom.functions.numbers import band
from ledgerloom.operators.dedupe import pick_per_key
from ledgerloom.operators.extract import ACTIVE, CLOSED, OVERPAID, REPAYMENT

# Days in arrears → class, and columns that must be filled.
CLASSES = [(0, 30, "B"), (30, 60, "C"), (60, 90, "D"), (90, None, "E")]
MANDATORY = ("surname", "forename_1", "date_of_birth", "loan_id", "gender", "id_type", "id_number", "mobile_number",
             "original_amount", "current_balance", "overdue_balance", "days_in_arrears", "instalments_in_arrears",
             "classification", "account_status", "account_status_date", "repayment_period", "disbursement_date",
             "last_payment_amount")
MONEY = ("original_amount", "current_balance", "overdue_balance", "instalment_amount", "last_payment_amount")


@dataclass(frozen=True)
class Portfolio:
    """Which loans of a product are submitted."""
    name: str
    version: str | None = None
    statuses: tuple = (ACTIVE, CLOSED, OVERPAID)
    disbursed_from: str | None = None
    disbursed_on: str | None = None
    products: tuple = ()
    balance: str = "core"          # core | partner | partner_or_settled | core_only
    test_clients: tuple = ()


def _belongs(portfolio: Portfolio):
    core, partner = F.col("total_outstanding"), F.col("partner_balance")
    rule = {
        "core": core.isNotNull(),
        "partner": partner.isNotNull(),
        "partner_or_settled": partner.isNotNull() | (core == 0),
        "core_only": (core > 0) & partner.isNull(),
    }[portfolio.balance]
    keep = rule & F.col("loan_status").isin(*portfolio.statuses)
    if portfolio.version:
        keep = keep & (F.col("version") == portfolio.version)
    if portfolio.disbursed_from:
        keep = keep & (F.col("disbursed_on") >= F.lit(as_date(portfolio.disbursed_from)))
    if portfolio.disbursed_on:
        keep = keep & (F.col("disbursed_on") == F.lit(as_date(portfolio.disbursed_on)))
    if portfolio.products:
        keep = keep & F.col("product_id").isin(*portfolio.products)
    if portfolio.test_clients:
        keep = keep & ~F.col("client_id").isin(*portfolio.test_clients)
    return keep


def select_portfolios(loans: DataFrame, clients: DataFrame, portfolios: dict, excluded: DataFrame | None = None) -> DataFrame:
    """Loans with a known client, once for each portfolio they fall in (column
    ``portfolio``), without the excluded accounts; one pass for all portfolios."""
    names = F.filter(F.array(*[F.when(_belongs(p), F.lit(name)) for name, p in portfolios.items()]), lambda n: n.isNotNull())
    out = loans.withColumn("_portfolios", names).filter(F.size("_portfolios") > 0)
    if excluded is not None:
        out = out.join(excluded.select("loan_id").filter("loan_id is not null").distinct(), "loan_id", "left_anti")
    return out.join(clients, "client_id").withColumn("portfolio", F.explode("_portfolios")).drop("_portfolios")


def select_portfolio(loans: DataFrame, clients: DataFrame, portfolio: Portfolio, excluded: DataFrame | None = None) -> DataFrame:
    """Loans of one portfolio."""
    return select_portfolios(loans, clients, {portfolio.name: portfolio}, excluded).drop("portfolio")


def outstanding(as_of, use_partner: bool):
    """Partner balance when it is fresh (less than two days old) or zero, else
    the core balance; never below zero."""
    core, partner = F.col("total_outstanding"), F.col("partner_balance")
    fresh = (F.col("partner_balance_date") > F.date_sub(F.lit(as_date(as_of)), 2)) | (partner == 0)
    usable = F.col("partner_balance_date").isNotNull() & fresh
    chosen = F.when(usable, F.coalesce(partner, core)).otherwise(core) if use_partner else core
    return F.greatest(chosen, F.lit(0).cast("double"))


def loan_records(loans: DataFrame, repayments: DataFrame, schedule: DataFrame, arrears: DataFrame, as_of,
                 use_partner: bool = True, rescheduled: bool = False) -> DataFrame:
    """One record per loan: balance, arrears, instalments, class and status.

    Each child table is reduced to one row per loan by a partial aggregate
    before it is joined.
    """
    as_of = as_date(as_of)
    last = repayments.filter(F.col("transaction_type") == REPAYMENT).groupBy("loan_id").agg(
        F.max(F.struct("transaction_id", "transaction_date", "amount")).alias("_p"))
    parts = ("principal_amount", "interest_amount", "fee_amount", "penalty_amount")
    amount = sum((F.coalesce(F.col(c), F.lit(0)) for c in parts), F.lit(0))
    open_ = F.col("completed") == 0
    plan = schedule.groupBy("loan_id").agg(
        F.min(F.struct(F.col("installment"), F.col("due_date"), amount.alias("amount"))).alias("_first"),
        F.min(F.when(open_, F.struct("installment", "due_date"))).alias("_next"),
        F.count_if(open_ & (F.col("due_date") <= F.lit(as_of))).alias("_overdue"))
    late = pick_per_key(arrears, ["loan_id"], ["overdue_since", "total_overdue"], largest=False)
    out = loans.join(last, "loan_id", "left").join(plan, "loan_id", "left").join(late, "loan_id", "left")
    out = out.withColumn("current_balance", outstanding(as_of, use_partner).cast("double"))
    settled, in_arrears = F.col("current_balance") == 0, F.col("overdue_since").isNotNull()
    days = F.when(in_arrears, F.greatest(F.datediff(F.lit(as_of), "overdue_since"), F.lit(0))).otherwise(0)
    overdue = F.coalesce(F.col("total_overdue").cast("double"), F.lit(0.0))
    out = out.withColumns({
        "days_in_arrears": F.when(settled, 0).otherwise(days).cast("long"),
        "overdue_balance": F.when(settled, 0.0).otherwise(overdue),
        "instalments_in_arrears": F.when(settled, 0).otherwise(F.coalesce("_overdue", F.lit(0))).cast("long"),
        "overdue_date": F.when(~settled & in_arrears & ((days > 0) | (F.floor(overdue) > 0)), F.col("overdue_since")),
        "instalment_amount": F.coalesce(F.col("_first.amount").cast("double"), F.lit(0.0)),
        "next_instalment_date": F.coalesce(F.col("_next.due_date"), F.col("matures_on")),
        "last_payment_date": F.col("_p.transaction_date"),
        "last_payment_amount": F.coalesce(F.floor(F.col("_p.amount").cast("double")).cast("double"), F.lit(0.0)),
    })
    d, status = F.col("days_in_arrears"), F.col("loan_status")
    state = (
        F.when(settled, "A")
        .when(status == ACTIVE, F.when(F.lit(rescheduled), "G").when(d > 60, "E").otherwise("F"))
        .when(status.isin(CLOSED, OVERPAID), "F"))
    closed = F.coalesce(F.col("closed_on"), F.col("disbursed_on"))
    since = F.when(status == ACTIVE, F.col("disbursed_on")).when(status.isin(500, CLOSED, OVERPAID), closed)
    if rescheduled:
        since = F.col("disbursed_on")
    else:
        since = F.when(in_arrears & ~settled, F.col("overdue_since")).otherwise(since)
    return out.withColumns({
        "classification": F.when(d == 0, "A").otherwise(band("days_in_arrears", CLASSES, "right")),
        "account_status": state, "account_status_date": since,
    }).drop("_p", "_first", "_next", "_overdue", "overdue_since", "total_overdue")


def gender_code(own, registry):
    code = lambda c: F.when(c == "Male", "M").when(c == "Female", "F")
    return F.coalesce(code(registry), code(own))


def term_months(frequency, unit, fixed: int | None = None):
    """Term in months: days and weeks count as one month."""
    if fixed is not None:
        return F.lit(fixed)
    return F.when(unit.isin(0, 1), 1).when(unit == 2, frequency)


def clean_records(records: DataFrame, as_of) -> tuple:
    """(records to submit, too small amounts, rejected records with the failed
    column). A record that fails several columns is listed once per column."""
    no_text = lambda c: F.when(F.length(c) <= 1, F.lit(None)).otherwise(c)
    out = records.withColumns({
        "forename_2": F.when(F.length("forename_2") == 1, F.lit(None)).otherwise(F.col("forename_2"))})
    out = out.withColumn("surname", F.coalesce(no_text(F.col("surname")), F.col("forename_2")))
    out = out.withColumn("forename_3", F.col("surname"))
    out = out.withColumn("overdue_balance", F.least("overdue_balance", "current_balance"))
    out = out.withColumn("overdue_date", F.when(
        (F.col("overdue_balance") > 0) & F.col("overdue_date").isNull(), F.col("account_status_date")).otherwise(F.col("overdue_date")))
    small = (F.col("original_amount") < 1000) & (F.col("current_balance") != 0)
    too_small = out.filter(small)
    out = out.filter((F.col("original_amount") >= 1000) | (F.col("current_balance") == 0)).filter("original_amount <> 0")
    has_letter = F.col("id_number").rlike(r"\p{L}")
    ident = F.when(F.coalesce(has_letter, F.lit(False)), "002").otherwise("001")
    unpaid = F.col("current_balance") != 0
    out = out.withColumns({
        "id_type": ident,
        "id_number": F.when(ident == "001", F.regexp_replace("id_number", r"[^\p{L}\p{N}]", "")).otherwise(F.col("id_number")),
        "date_of_birth": plausible_birth_date(F.col("date_of_birth"), as_of),
        "account_status_date": F.coalesce("account_status_date", "overdue_date", "disbursement_date"),
        "_unpaid": unpaid,
        **{c: text.letters_title(F.col(c)) for c in ("surname", "forename_1", "forename_2", "forename_3")},
        **{c: text.minor_units(F.col(c)) for c in MONEY},
        "mobile_number": F.split_part("mobile_number", F.lit("_"), F.lit(1)),
    }).distinct()
    failed = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in MANDATORY]), lambda c: c.isNotNull())
    marked = out.withColumn("_failed", failed)
    good = marked.filter(F.size("_failed") == 0).drop("_failed", "_unpaid")
    bad = marked.filter("_unpaid").withColumn("exception_column", F.explode("_failed")).drop("_failed", "_unpaid")
    return good, too_small, bad
