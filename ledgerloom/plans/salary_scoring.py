"""Salary-based scoring for all clients in one job."""
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.functions.dates import as_date, shift_months
from ledgerloom.functions.numbers import clamp_limit, half_even, round_up
from ledgerloom.operators.dedupe import first_two, latest_per_key

# Limit factors, limit ranges, debt share and running loans allowed.
FACTORS = {6: 1.0, 3: 0.5, 1: 0.2}
RANGE, PAYDAY_RANGE = (30000, 1000000), (15000, 250000)
MAX_DEBT_SHARE, MAX_RUNNING_LOANS = 0.5, 5
# Product ids of the three and six month tenors.
THREE_MONTHS, SIX_MONTHS = 18, 19


def employer_flags(salaries: DataFrame, government: DataFrame, multinational: DataFrame) -> DataFrame:
    """Employer class from the two company lists (column ``company``)."""
    def mark(df, names, flag):
        known = names.select(F.col("company").alias("_name")).distinct().withColumn("_hit", F.lit(True))
        return df.join(known, F.col("company") == F.col("_name"), "left").withColumn(
            flag, F.coalesce("_hit", F.lit(False))).drop("_name", "_hit")
    return mark(mark(salaries, government, "is_government"), multinational, "is_multinational")


def eligibility(clients: DataFrame, salaries: DataFrame, as_of) -> DataFrame:
    """Whether the latest salary lies within nine and six months, and the
    employer class that goes with it; several latest rows are merged."""
    latest = latest_per_key(salaries, "client_id", F.col("paid_at").desc()).groupBy("client_id").agg(
        F.max("paid_at").alias("_last"), F.bool_or("is_government").alias("_g"), F.bool_or("is_multinational").alias("_m"))
    within = lambda n: F.coalesce(F.col("_last") > F.lit(shift_months(as_of, -n)), F.lit(False))
    return clients.join(latest, "client_id", "left").select(
        "client_id", within(9).alias("last_salary_within_9_months"), within(6).alias("last_salary_within_6_months"),
        F.coalesce("_g", F.lit(False)).alias("is_government"), F.coalesce("_m", F.lit(False)).alias("is_multinational"))


def salary_summary(salaries: DataFrame, dataset_end, legacy: bool = False) -> DataFrame:
    """Salary measures over nine, six and three months, per client.

    ``dataset_end`` is the last payment date of the data. Government employees
    are seen over nine months, others over six; the three-month window ends with
    the client's own last month. Of several payments on one day one counts, but
    the six-month mean of government employees counts all of them.

    Rows are merged per client and day, then per client and month; what is left
    for the final step are a handful of months per client.
    """
    end = as_date(dataset_end)
    month_of = lambda n: shift_months(end.replace(day=1), -n)
    start = F.when(F.col("is_government"), F.lit(month_of(9))).otherwise(F.lit(month_of(6)))
    rows = salaries.filter((F.col("paid_at") >= F.lit(month_of(9))) & (F.col("paid_at") >= start))
    payment = ["client_id", "paid_at", "amount", "account", "bank"]
    if not legacy:
        # Copies of one payment: the latest record counts.
        rows = rows.groupBy(*payment).agg(
            F.max("created_at").alias("created_at"), F.bool_and("is_government").alias("is_government"),
            F.bool_or("is_multinational").alias("is_multinational"))
    days = rows.groupBy("client_id", F.to_date("paid_at").alias("day")).agg(
        F.max_by("amount", F.struct("created_at", "amount")).alias("one"), F.sum("amount").alias("every"),
        F.bool_and("is_government").alias("g"), F.bool_or("is_multinational").alias("m"))
    months = days.groupBy("client_id", F.trunc("day", "MM").alias("month")).agg(
        F.sum("one").alias("one"), F.sum("every").alias("every"), F.count(F.lit(1)).alias("n"), F.min("one").alias("least"),
        F.min("day").alias("first"), F.max("day").alias("last"), F.bool_and("g").alias("g"), F.bool_or("m").alias("m"))
    whole = Window.partitionBy("client_id")
    months = months.withColumns({
        "last_month": F.max("month").over(whole), "gov": F.min(F.col("g").cast("int")).over(whole) == 1})
    in6 = F.col("month") >= F.lit(month_of(5))
    in_long = F.when(F.col("gov"), F.col("month") >= F.lit(month_of(8))).otherwise(in6)
    in3 = F.col("month") >= F.add_months("last_month", -2)

    def measures(cond, tag):
        on = lambda c: F.when(cond, F.col(c))
        return [
            F.coalesce(F.sum(on("n")), F.lit(0)).alias(f"count_of_payments_{tag}"),
            F.coalesce(F.sum(on("one")).cast("double"), F.lit(0.0)).alias(f"sum_of_payments_{tag}"),
            F.coalesce(F.min(on("least")).cast("double"), F.lit(0.0)).alias(f"minimum_payment_{tag}"),
            F.min(on("first")).alias(f"earliest_payment_{tag}"), F.max(on("last")).alias(f"latest_payment_{tag}"),
            (F.sum(on("one")).cast("double") / F.count(on("one"))).alias(f"_average_{tag}"),
            F.coalesce(F.max_by(on("one"), on("month")).cast("double"), F.lit(0.0)).alias(f"latest_amount_{tag}"),
        ]

    out = months.groupBy("client_id").agg(
        F.bool_or("gov").alias("is_government"), F.bool_or("m").alias("is_multinational"), *measures(in_long, "long"),
        *measures(in3, "3m"), (F.sum(F.when(in6, F.col("every"))).cast("double") / F.count(F.when(in6, F.lit(1)))).alias("_six"))
    out = out.withColumns({
        "months_in_period": F.when(F.col("is_government"), 9).otherwise(6),
        "average_monthly_long": F.coalesce("_average_long", F.lit(0.0)),
        "average_monthly_3m": F.coalesce("_average_3m", F.lit(0.0)),
        "average_monthly_6m": F.coalesce(F.when(F.col("is_government"), F.col("_six")).otherwise(F.col("_average_long")), F.lit(0.0)),
    })
    steady = (F.col("count_of_payments_long") >= 6) | (
        ~F.col("is_government") & (F.col("count_of_payments_long") > 0)
        & (F.col("sum_of_payments_long") >= F.col("average_monthly_long") * 6))
    return out.withColumns({
        "is_qualified_on_salaries": steady, "payday_is_qualified_on_salaries": F.col("count_of_payments_3m") >= 2,
    }).drop("_average_long", "_average_3m", "_six")


def with_defaults(clients: DataFrame, summary: DataFrame, default_day) -> DataFrame:
    """Clients without salaries appear with zero measures and the default day."""
    out = clients.select("client_id").distinct().join(summary, "client_id", "left")
    fills = {}
    for f in summary.schema.fields:
        if f.name == "client_id":
            continue
        kind = f.dataType.simpleString()
        value = F.lit(as_date(default_day)) if kind == "date" else F.lit(False) if kind == "boolean" else (
            F.lit(6) if f.name == "months_in_period" else F.lit(0).cast(f.dataType))
        fills[f.name] = F.coalesce(F.col(f.name), value)
    return out.withColumns(fills)


def debt_and_limits(summary: DataFrame, debts: DataFrame, as_of_copies: bool = True) -> DataFrame:
    """Debt share, limits and qualification for three tenors.

    ``debts``: client, lender, disbursed_at, status, amounts, created_at; copies
    of one debt are merged. A salary of zero counts as a debt share of one.
    """
    key = ["client_id", "lender", "disbursed_at", "status", "loan_amount", "outstanding", "repayment"]
    one = debts.groupBy(*key).agg(F.max("created_at").alias("created_at")) if as_of_copies else debts
    # Per client and day first: the distinct count then runs on a small table.
    daily = one.groupBy("client_id", F.to_date("disbursed_at").alias("day")).agg(
        F.sum("repayment").alias("repayment"), F.max(F.col("outstanding") > 0).alias("running"))
    totals = daily.groupBy("client_id").agg(
        F.sum("repayment").cast("double").alias("total_debt_value"), F.count_if("running").alias("count_of_running_loans"))
    out = summary.join(totals, "client_id", "left").na.fill(0, ["total_debt_value", "count_of_running_loans"])
    share = lambda salary: F.coalesce(half_even(F.try_divide(F.col("total_debt_value"), F.col(salary)), 1), F.lit(1.0))
    out = out.withColumns({"debt_share": share("average_monthly_long"), "payday_debt_share": share("average_monthly_3m")})
    eligible = F.col("is_government") | F.col("is_multinational")
    raw = {
        6: F.lit(FACTORS[6]) * F.col("average_monthly_long") * (1 - F.col("debt_share")),
        3: F.lit(FACTORS[3]) * F.col("average_monthly_long") * (1 - F.col("debt_share")),
        1: F.when(eligible, F.lit(FACTORS[1]) * F.col("average_monthly_3m") * (1 - F.col("payday_debt_share"))).otherwise(0.0),
    }
    out = out.withColumns({f"rounded_limit_{n}m": round_up(c) for n, c in raw.items()})
    out = out.withColumns({f"limit_{n}m": clamp_limit(F.col(f"rounded_limit_{n}m"), *(PAYDAY_RANGE if n == 1 else RANGE))
                           for n in raw})
    latest, least, mean = F.col("latest_amount_3m"), F.col("minimum_payment_3m"), F.col("average_monthly_3m")
    out = out.withColumns({
        "latest_covers_minimum": F.col("latest_amount_long") >= F.col("minimum_payment_long"),
        "payday_latest_covers_minimum": (latest >= least) | (latest >= mean)})
    base = (F.col("is_qualified_on_salaries") & (F.col("debt_share") <= MAX_DEBT_SHARE) & F.col("latest_covers_minimum")
            & (F.col("count_of_running_loans") <= MAX_RUNNING_LOANS))
    payday = (eligible & F.col("payday_is_qualified_on_salaries") & (F.col("payday_debt_share") <= MAX_DEBT_SHARE)
              & F.col("payday_latest_covers_minimum") & (F.col("count_of_running_loans") <= MAX_RUNNING_LOANS))
    return out.withColumns({
        "is_3m_qualified": base & (F.col("limit_3m") > 0), "is_6m_qualified": base & (F.col("limit_6m") > 0),
        "is_1m_qualified": payday & (F.col("limit_1m") > 0)}).withColumn(
        "is_qualified", F.col("is_3m_qualified") | F.col("is_6m_qualified"))


def tenure_rules(clients: DataFrame, loans: DataFrame, as_of) -> DataFrame:
    """Whether a client may have the six-month tenor.

    Either the client's first loan already was one (and there are two or more),
    or the last two three-month loans are complete, not more than 45 days apart,
    and the last one is at least 60 days old.
    """
    as_of = as_date(as_of)
    history = loans.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min_by("product_id", "loan_id").alias("_first_product"))
    two = first_two(loans.filter(F.col("product_id") == THREE_MONTHS), "client_id",
                    [F.col("disbursed_on").desc(), F.col("loan_id").desc()], ["disbursed_on", "closed_on", "matures_on"])
    pair = F.col("n_rows") == 2
    yes = lambda c: F.coalesce(c, F.lit(False))
    out = clients.select("client_id").distinct().join(history, "client_id", "left").join(two, "client_id", "left").select(
        "client_id",
        yes((F.col("_n") >= 2) & (F.col("_first_product") == SIX_MONTHS)).alias("had_six_months"),
        yes(pair & F.col("closed_on_1").isNotNull() & F.col("closed_on_2").isNotNull()
            & (F.col("matures_on_1") <= F.lit(as_of)) & (F.col("matures_on_2") <= F.lit(as_of))).alias("is_complete"),
        yes(pair & (F.datediff("disbursed_on_1", "disbursed_on_2") <= 45)).alias("is_consecutive"),
        yes(F.date_add("disbursed_on_1", 60) <= F.lit(as_of)).alias("is_recent"))
    return out.withColumn("passes", F.col("had_six_months") | (
        F.col("is_complete") & F.col("is_consecutive") & F.col("is_recent")))


def loan_counts(clients: DataFrame, loans: DataFrame, products: list, statuses=(300, 600, 700)) -> DataFrame:
    counted = loans.filter(F.col("product_id").isin(products) & F.col("loan_status").isin(*statuses)
                           & F.col("disbursed_on").isNotNull()).groupBy("client_id").agg(F.count(F.lit(1)).alias("count_of_loans"))
    return clients.select("client_id").distinct().join(counted, "client_id", "left").na.fill(0, ["count_of_loans"])


def shared_limits(df: DataFrame) -> DataFrame:
    """Limits and tenors to publish; the six-month one needs three loans."""
    three, six = F.col("is_3m_qualified"), F.col("is_6m_qualified") & (F.col("count_of_loans") > 2)
    return df.withColumns({
        "limit_to_share_3m": F.when(three, F.col("limit_3m")).otherwise(0.0), "tenure_3m": F.when(three, 3).otherwise(-1),
        "limit_to_share_6m": F.when(six, F.col("limit_6m")).otherwise(0.0), "tenure_6m": F.when(six, 6).otherwise(-1),
        "payday_limit_to_share": F.when(F.col("is_1m_qualified"), F.col("limit_1m")).otherwise(0.0)})


def narrations(df: DataFrame) -> DataFrame:
    """Reason text and code of the salary and the payday product."""
    # Reason texts and codes.
    no_salary = ("Client has not received consistent salary payment in recent months", " B005")
    no_history = ("inadequate payment history to check", "C005")
    debt = ("Client has high debt exposure", "C004")
    running = ("Client has high number of running loans", " D006")
    granted = ("Limits assigned per lending criteria ", " F001")
    employer = ("Employer not eligible", "E002")
    small = ("Limits assigned less than product thresholds", " D001")

    final3 = F.col("is_3m_qualified") & F.col("bureau_qualified")
    final6 = F.col("is_6m_qualified") & F.col("bureau_qualified") & F.col("tenure_passes")
    eligible = F.col("is_government") | F.col("is_multinational")
    salary_rules = [
        (~F.col("is_qualified_on_salaries"), no_salary), (~F.col("bureau_qualified"), no_history),
        (~F.col("latest_covers_minimum"), no_salary), (F.col("debt_share") > MAX_DEBT_SHARE, debt),
        (F.col("count_of_running_loans") > MAX_RUNNING_LOANS, running),
        (((F.col("limit_6m") > 0) | (F.col("limit_3m") > 0)) & (final3 | final6), granted)]
    payday_rules = [
        (~F.col("payday_is_qualified_on_salaries"), no_salary), (~F.col("payday_bureau_qualified"), no_history),
        (~F.col("payday_latest_covers_minimum"), (no_salary[0], "B005")), (F.col("payday_debt_share") > MAX_DEBT_SHARE, debt),
        (F.col("count_of_running_loans") > MAX_RUNNING_LOANS, running),
        ((F.col("limit_1m") > 0) & F.col("is_1m_qualified") & F.col("payday_bureau_qualified"), granted), (~eligible, employer)]

    def pick(rules, part):
        out = F.when(F.lit(False), F.lit(""))
        for rule, text in rules:
            out = out.when(rule, F.lit(text[part]))
        return out.otherwise(F.lit(small[part]))

    outside = lambda c: F.when(eligible, c).otherwise(F.lit("Employer not eligible"))
    return df.withColumns({
        "final_qualified_3m": final3, "final_qualified_6m": final6,
        "rules_summary": pick(salary_rules, 0), "reason_code": pick(salary_rules, 1),
        "payday_rules_summary": outside(pick(payday_rules, 0)), "payday_reason_code": outside(pick(payday_rules, 1))})
