"""Agent scoring for the whole population in one job."""
from pyspark.sql import DataFrame, functions as F

from ledgerloom.functions.dates import DAYS_PER_MONTH, as_date, fractional_months, shift_months
from ledgerloom.functions.numbers import band, clamp_limit, half_even, matrix, round_up, sum_of

APPROVED = "Approved"
COMMISSION = "Agent Commission"

# Score bands as (from, to, score).
TRADING_CONSISTENCY = [(0, 0.30, -100), (0.30, 0.50, 0), (0.50, 0.60, 50), (0.60, 0.75, 100), (0.75, 0.90, 150)]
TRADING_CONSISTENCY_TOP = [(0.90, 1.00, 200)]
AGE_ON_NETWORK = [(1, 3, 0), (3, 4, 50), (4, 5, 100), (5, None, 200)]
AGE_ON_NETWORK_FIRST = [(0, 1, -100)]
RECENCY = [(0, 1, 200), (1, 2, 150), (2, 4, 100), (4, 6, 0), (6, 8, -50), (8, 10, -100), (10, None, -200)]
DAILY_DEBIT = [(0, 20000, -100), (20000, 35000, 0), (35000, 50000, 25), (50000, 100000, 35), (100000, 200000, 50),
               (200000, 500000, 75), (500000, 750000, 100), (750000, 1000000, 150), (1000000, None, 200)]
COMMISSION_DAYS = [(0, 1, -150), (1, 2, -100), (2, 3, 0), (3, 5, 100), (5, 6, 150), (6, None, 200)]

# Loan count and repayment bands, limit factors, limit range, pass mark.
LOAN_COUNT = [(0, 0, "Band 1"), (1, 2, "Band 2"), (3, 5, "Band 3"), (6, 9, "Band 4"), (10, None, "Band 5")]
REPAYMENT_LEGACY = [(0, 29, "Band 1"), (30, 49, "Band 2"), (50, 69, "Band 3"), (70, 89, "Band 4"), (90, 99, "Band 5"),
                    (100, None, "Band 6")]
REPAYMENT = [(0, 30, "Band 1"), (30, 50, "Band 2"), (50, 70, "Band 3"), (70, 90, "Band 4"), (90, 100, "Band 5"),
             (100, None, "Band 6")]
LIMIT_FACTORS = {
    ("Band 2", "Band 4"): 0.083, ("Band 2", "Band 5"): 0.108, ("Band 2", "Band 6"): 0.128,
    ("Band 3", "Band 4"): 0.098, ("Band 3", "Band 5"): 0.123, ("Band 3", "Band 6"): 0.136,
    ("Band 4", "Band 4"): 0.113, ("Band 4", "Band 5"): 0.138, ("Band 4", "Band 6"): 0.145,
    ("Band 5", "Band 4"): 0.128, ("Band 5", "Band 5"): 0.153, ("Band 5", "Band 6"): 0.17,
}
FIRST_LOAN_FACTOR = 0.119
MINIMUM_LIMIT, MAXIMUM_LIMIT, PASS_MARK = 35000, 1000000, 600


def commission_summary(activity: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Approved commissions dated after ``as_of`` minus the window.

    Sums per agent, day and service come first, so the distinct counts run on
    that small table and a busy agent is spread over its days.
    """
    start = shift_months(as_of, -months)
    paid = activity.filter((F.col("ts") >= F.date_add(F.lit(start), 1)) & (F.col("biller") == COMMISSION)
                           & (F.col("status") == APPROVED) & F.col("agent_id").isNotNull())
    daily = paid.groupBy("agent_id", F.to_date("ts").alias("day"), "narration").agg(F.sum("credit").alias("credit"))
    return daily.groupBy("agent_id").agg(
        F.sum("credit").cast("double").alias("total_commissions_amount"),
        F.countDistinct("day").alias("unique_number_of_commissions"),
        F.countDistinct("narration").alias("unique_number_of_services_offered"),
        F.countDistinct(F.trunc("day", "MM")).alias("number_of_months_received_commissions"))


def activity_summary(activity: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Approved debits since ``as_of`` minus the window, per agent.

    Measures come from rows with a balance of zero or more; rows with a negative
    balance only describe the negative balances. Agents without a row of the
    first kind have no summary.
    """
    end, start = as_date(as_of), shift_months(as_of, -months)
    rows = activity.filter((F.col("ts") >= F.lit(start)) & (F.col("debit") > 0) & (F.col("status") == APPROVED)
                           & F.col("agent_id").isNotNull())
    good = F.col("balance") >= 0
    daily = rows.groupBy("agent_id", F.to_date("ts").alias("day"), "biller", good.alias("good")).agg(
        F.sum("debit").alias("debit"), F.count(F.lit(1)).alias("n"), F.min("debit").alias("min_debit"),
        F.max("debit").alias("max_debit"), F.sum("balance").alias("balance"), F.min("balance").alias("min_balance"),
        F.max("balance").alias("max_balance"))
    g, b = F.col("good"), ~F.col("good")
    on = lambda cond, c: F.when(cond, F.col(c))
    agents = daily.groupBy("agent_id").agg(
        F.sum(on(g, "debit")).alias("_debit"), F.sum(on(g, "n")).alias("_n"), F.sum(on(g, "balance")).alias("_balance"),
        F.min(on(g, "day")).alias("earliest_transaction_date"), F.max(on(g, "day")).alias("latest_transaction_date"),
        F.countDistinct(on(g, "biller")).alias("no_of_services_offered"),
        F.min(on(g, "min_balance")).cast("double").alias("min_balance"),
        F.max(on(g, "max_balance")).cast("double").alias("max_balance"),
        F.min(on(g, "min_debit")).cast("double").alias("min_debit_amt"),
        F.max(on(g, "max_debit")).cast("double").alias("max_debit_amt"),
        F.countDistinct(on(g, "day")).alias("unique_transaction_days"),
        F.countDistinct(F.trunc(on(g, "day"), "MM")).alias("unique_transaction_months"),
        F.coalesce(F.min(on(b, "min_balance")).cast("double"), F.lit(0.0)).alias("lowest_negative_balance"),
        F.coalesce(F.max(on(b, "max_balance")).cast("double"), F.lit(0.0)).alias("highest_negative_balance"),
        F.min(on(b, "day")).alias("_first_negative"), F.max(on(b, "day")).alias("_last_negative"),
        F.countDistinct(on(b, "day")).alias("unique_negative_balance_dates"),
    ).filter("_n > 0")
    # Distinct requests are spread by request, not by agent.
    requests = rows.filter(good).groupBy("agent_id").agg(F.countDistinct("request_ref").alias("total_transactions"))
    expected = float((end - start).days + 1)
    out = agents.join(requests, "agent_id").withColumns({
        "total_debit_amount": F.col("_debit").cast("double"),
        "average_transaction_size": F.col("_debit").cast("double") / F.col("_n"),
        "average_balance": F.col("_balance").cast("double") / F.col("_n"),
        "expected_transaction_days": F.lit(expected),
        "earliest_negative_balance_date": F.coalesce("_first_negative", "latest_transaction_date"),
        "latest_negative_balance_date": F.coalesce("_last_negative", "latest_transaction_date"),
    })
    return out.withColumns({
        "daily_trading_consistency": half_even(F.col("unique_transaction_days") / F.lit(expected), 2),
        "average_daily_transactions": F.rint(F.col("total_transactions") / F.col("unique_transaction_days")),
        "average_daily_debit_amt": F.rint(F.col("total_debit_amount") / F.lit(expected)),
        "days_since_last_transaction": F.datediff(F.lit(end), "latest_transaction_date"),
        "days_since_latest_negative_balance": F.datediff("latest_transaction_date", "latest_negative_balance_date"),
    }).drop("_debit", "_n", "_balance", "_first_negative", "_last_negative")


def scores(summaries: DataFrame, period_end: str | None = None) -> DataFrame:
    """Five band scores and their total (a value outside all bands scores nothing).

    The period ends with the agent's own last trading day, as when agents are
    scored one by one; ``period_end`` gives a common day instead.
    """
    end = F.lit(as_date(period_end)) if period_end else F.col("latest_transaction_date")
    out = summaries.withColumn("latest_trading_month", end).withColumns({
        "evaluation_months": F.ceil(fractional_months(F.col("latest_trading_month"), F.col("earliest_transaction_date")) + 1),
        "diff_last_txn_month": F.rint(fractional_months(F.col("latest_trading_month"), F.col("latest_transaction_date"))),
    })
    consistency, age = "daily_trading_consistency", "evaluation_months"
    parts = {
        "trading_consistency_score": F.coalesce(
            band(consistency, TRADING_CONSISTENCY), band(consistency, TRADING_CONSISTENCY_TOP, "both")),
        "age_on_network_score": F.coalesce(band(age, AGE_ON_NETWORK_FIRST, "both"), band(age, AGE_ON_NETWORK, "right")),
        "recency_in_months_score": band("diff_last_txn_month", RECENCY),
        "average_daily_debit_score": band("average_daily_debit_amt", DAILY_DEBIT),
        "unique_number_of_commissions_score": band("unique_number_of_commissions", COMMISSION_DAYS),
    }
    return out.withColumns(parts).withColumn("total_score", sum_of(*[F.col(p) for p in parts]))


def loan_history(clients: DataFrame, loans: DataFrame, repayments: DataFrame, as_of, legacy: bool = False) -> DataFrame:
    """Per agent: loan count, months since the last disbursement, hurdle rate.

    The hurdle rate is what was repaid before nine days after maturity (two
    rollover days and seven more) as a percentage of all principal, per client.
    legacy=True rounds the ratio before it is scaled, giving only 0, 100, 200, …
    """
    due = F.date_add(F.date_add("matures_on", 2), 7)
    # An inner join, as Spark can split a hot loan on either side of it.
    in_time = loans.select("loan_id", due.alias("_due")).join(repayments.select("loan_id", "paid_on", "amount"), "loan_id").filter(
        F.col("paid_on") < F.col("_due")).groupBy("loan_id").agg(F.sum("amount").alias("_paid"))
    by_client = loans.join(in_time, "loan_id", "left").groupBy("client_id").agg(
        F.count("loan_id").alias("count_of_loans"), F.max("disbursed_on").alias("_last"),
        F.sum("principal").alias("_principal"), F.sum("_paid").alias("_paid"))
    ratio = F.try_divide(F.col("_paid").cast("double"), F.col("_principal").cast("double"))
    percent = F.rint(ratio) * 100 if legacy else ratio * 100
    return clients.join(by_client, "client_id").select(
        "agent_id", "client_id", "count_of_loans",
        (F.datediff(F.lit(as_date(as_of)), "_last") / F.lit(DAYS_PER_MONTH)).alias("months_since_last_disbursement"),
        F.col("_principal").cast("double").alias("total_principal"),
        F.col("_paid").cast("double").alias("repayments_in_time"), percent.alias("percentage_repayment_in_time"))


def limit_factor(loan_band: str, repayment_band: str):
    return F.when(F.col(loan_band) == "Band 1", F.lit(FIRST_LOAN_FACTOR)).otherwise(
        matrix(loan_band, repayment_band, LIMIT_FACTORS, 0.0))


def limits(scored: DataFrame, history: DataFrame, legacy: bool = False) -> DataFrame:
    """Limit per agent from the daily debit and the limit matrix; a first loan
    gets half of it, but not less than the product minimum."""
    out = scored.join(history, "agent_id", "left").withColumn(
        "count_of_loans", F.coalesce("count_of_loans", F.lit(0)))
    out = out.withColumns({
        "loan_band": band("count_of_loans", LOAN_COUNT, "both"),
        "repayment_band": band("percentage_repayment_in_time", REPAYMENT_LEGACY, "both") if legacy
        else band("percentage_repayment_in_time", REPAYMENT),
    })
    out = out.withColumn("limit_factor", limit_factor("loan_band", "repayment_band"))
    out = out.withColumn("minimum_limit", F.col("average_daily_debit_amt") * 30 * F.col("limit_factor"))
    out = out.withColumn("rounded_limit", round_up(F.col("minimum_limit")))
    capped = clamp_limit(F.col("rounded_limit"), MINIMUM_LIMIT, MAXIMUM_LIMIT)
    first = (F.col("count_of_loans") == 0) & (capped > 0)
    return out.withColumn(
        "current_limit", F.when(first, F.greatest(capped * 0.5, F.lit(float(MINIMUM_LIMIT)))).otherwise(capped))


def earlier_limits(results: DataFrame, as_of) -> DataFrame:
    """Last limit and the limits as of one and two months ago, per agent, in one
    pass over the stored results.

    The row with the largest model version before a cut must also carry the
    largest row id, otherwise there is no limit for that cut. Without the
    one-month limit there is no two-month limit either.
    """
    version_day = F.to_date(F.trim(F.regexp_extract("model_version", r"\s.*\d", 0)))
    dated = results.withColumn("_day", version_day)
    row = F.struct("model_version", "result_id", "limit")
    out = [F.max(row).alias("_last")]
    for months in (1, 2):
        before = F.col("_day") < F.lit(shift_months(as_of, -months))
        out += [F.max(F.when(before, row)).alias(f"_m{months}"), F.max(F.when(before, F.col("result_id"))).alias(f"_id{months}")]
    pick = lambda n: F.when(F.col(f"_m{n}.result_id") == F.col(f"_id{n}"), F.col(f"_m{n}.limit"))
    return dated.groupBy("agent_id").agg(*out).select(
        "agent_id", F.col("_last.limit").alias("previous_limit"), pick(1).alias("previous_m_limit"),
        F.when(pick(1).isNotNull(), pick(2)).alias("previous_2m_limit"))


def stabilise(current: DataFrame, past: DataFrame) -> DataFrame:
    """Hold limits that move little, cap growth, and look back two months.
    Agents without history count as having had no limit (zero)."""
    out = current.join(past, "agent_id", "left").na.fill(0.0, ["previous_limit", "previous_m_limit", "previous_2m_limit"])
    now, before, two = F.col("current_limit"), F.col("previous_limit"), F.col("previous_2m_limit")
    held = (
        F.when((now == 0) | (before == 0), now)
        .when(now >= before * 1.5, before * 1.5)
        .when((now >= before * 0.85) & (now <= before * 1.15), before)
        .otherwise(now))
    out = out.withColumn("limit_after_stabilisation", held)
    kept = F.col("limit_after_stabilisation")
    return out.withColumn("final_limit", F.when(kept == 0, kept).when(before > two, before)
                          .when((before < two) & (kept > before), before).otherwise(kept))


def graduate(now, before, loan_count, months):
    """Limit of an agent who borrowed within the last month: the old one, if any."""
    return F.when((now != 0) & (months <= 1) & (loan_count > 1) & (before > 0), before).otherwise(now)


def qualify(df: DataFrame, lender: str = "our") -> DataFrame:
    """Qualification flags and the reason text, split into its three parts."""
    passed = (F.col("final_limit") > 0) & (F.col("total_score") >= PASS_MARK)
    out = df.withColumn("is_qualified", F.coalesce(passed, F.lit(False)))
    # Reason texts.
    advice = ("Based on historical and current information on your business and loan history, "
              f"you do not currently meet {lender} lending criteria: C004")
    below = [
        (F.col("trading_consistency_score") <= 0, "Trading consistency is below set threshold and total score is < 600. "),
        (F.col("average_daily_debit_score") <= 0, "Average daily debit amount is below set threshold and total score is < 600. "),
        (F.col("total_score") < PASS_MARK, "Total score is below 600. "),
        (F.col("age_on_network_score") <= 0, "Age on network is below set threshold and total score is < 600. "),
        (F.col("recency_in_months_score") <= 0, "Number of months with no activity is below set threshold and total score is < 600. "),
        (F.col("unique_number_of_commissions_score") <= 0, "Number of commission payments is below set threshold and total score is < 600. "),
    ]
    late = "Inconsistent Repayments. : You have been inconsistent in paying your loans on time - please consistently pay your loans on time: A001"
    fine = "All rules passed. : Limits assigned per lending criteria : F001"
    small = "Limit below product min : Limits assigned less than product thresholds: D001"
    reason = F.when(F.lit(False), F.lit(""))
    for rule, words in below:
        reason = reason.when(rule & ~F.col("is_qualified"), F.lit(f"{words}: {advice}"))
    reason = reason.when(F.col("limit_factor") == 0, F.lit(late)).when(
        (F.col("final_limit") > 0) & F.col("is_qualified"), F.lit(fine)).otherwise(F.lit(small))
    parts = F.split(reason, ":")
    return out.withColumns({
        "rules_summary": F.get(parts, F.lit(0)), "communication": F.get(parts, F.lit(1)), "reason_code": F.get(parts, F.lit(2))})


def score_agents(activity, clients, loans, repayments, results, as_of, months: int = 6, legacy: bool = False) -> DataFrame:
    """From raw activity to published limits, for all agents."""
    summaries = commission_summary(activity, as_of, months).join(activity_summary(activity, as_of, months), "agent_id")
    known = scores(summaries).join(clients.select("agent_id").distinct(), "agent_id", "left_semi")
    limited = limits(known, loan_history(clients, loans, repayments, as_of, legacy), legacy)
    return qualify(stabilise(limited, earlier_limits(results, as_of)))
