import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import agent_scoring as agents, bureau_rules, salary_scoring as salary

T, D = dt.datetime, dt.date
AS_OF = "2024-01-31"


@pytest.fixture(scope="module")
def activity(spark):
    rows = [
        # agent, ts, ref, status, biller, narration, debit, credit, balance
        ("a", T(2023, 7, 31), 1, "Approved", "air", "n1", 100.0, 0.0, 50.0),      # first day of the window counts
        ("a", T(2023, 7, 30, 23), 2, "Approved", "air", "n1", 900.0, 0.0, 50.0),  # the day before does not
        ("a", T(2024, 1, 10, 9), 3, "Approved", "bill", "n1", 300.0, 0.0, 0.0),
        ("a", T(2024, 1, 10, 10), 3, "Approved", "bill", "n1", 50.0, 0.0, 10.0),  # same request
        ("a", T(2024, 1, 5), 4, "Approved", "bill", "n1", 70.0, 0.0, -20.0),      # negative balance
        ("a", T(2024, 1, 6), 5, "Declined", "bill", "n1", 70.0, 0.0, 20.0),
        ("a", T(2024, 1, 7), 6, "Approved", "Agent Commission", "n1", 0.0, 5.0, 20.0),
        ("a", T(2023, 7, 31), 7, "Approved", "Agent Commission", "n2", 0.0, 9.0, 20.0),  # commissions start a day later
        ("b", T(2024, 1, 5), 8, "Approved", "bill", "n1", 70.0, 0.0, -20.0),      # only negative: no summary
    ]
    return spark.createDataFrame(rows, "agent_id string, ts timestamp_ntz, request_ref int, status string, biller string, narration string, "
                                       "debit double, credit double, balance double")


def test_activity_summary(activity):
    out = agents.activity_summary(activity, AS_OF).collect()
    assert [r.agent_id for r in out] == ["a"]
    r = out[0]
    assert (r.total_debit_amount, r.total_transactions, r.no_of_services_offered) == (450.0, 2, 2)
    assert r.average_transaction_size == 150.0 and r.unique_transaction_days == 2
    assert (r.earliest_transaction_date, r.latest_transaction_date) == (D(2023, 7, 31), D(2024, 1, 10))
    assert (r.lowest_negative_balance, r.latest_negative_balance_date, r.days_since_latest_negative_balance) == (-20.0, D(2024, 1, 5), 5)
    assert r.expected_transaction_days == 185.0 and r.daily_trading_consistency == 0.01


def test_commission_window_is_open_at_its_start(activity):
    out = agents.commission_summary(activity, AS_OF).collect()
    assert [(r.agent_id, r.total_commissions_amount, r.unique_number_of_commissions) for r in out] == [("a", 5.0, 1)]


def summaries(spark, **over):
    base = dict(agent_id="a", daily_trading_consistency=0.95, earliest_transaction_date=D(2023, 8, 1), latest_transaction_date=D(2024, 1, 30),
                average_daily_debit_amt=60000.0, unique_number_of_commissions=6)
    base.update(over)
    return spark.createDataFrame([tuple(base.values())], "agent_id string, daily_trading_consistency double, earliest_transaction_date date, "
                                                         "latest_transaction_date date, average_daily_debit_amt double, unique_number_of_commissions int")


@pytest.mark.parametrize("over, column, want", [
    (dict(daily_trading_consistency=0.3), "trading_consistency_score", 0), (dict(daily_trading_consistency=0.29), "trading_consistency_score", -100),
    (dict(daily_trading_consistency=1.0), "trading_consistency_score", 200), (dict(daily_trading_consistency=1.01), "trading_consistency_score", None),
    (dict(average_daily_debit_amt=20000.0), "average_daily_debit_score", 0), (dict(average_daily_debit_amt=1e6), "average_daily_debit_score", 200),
    (dict(unique_number_of_commissions=0), "unique_number_of_commissions_score", -150), (dict(unique_number_of_commissions=5), "unique_number_of_commissions_score", 150),
    (dict(earliest_transaction_date=D(2024, 1, 30)), "age_on_network_score", -100), (dict(earliest_transaction_date=D(2024, 1, 29)), "age_on_network_score", 0),
])
def test_score_bands(spark, over, column, want):
    assert agents.scores(summaries(spark, **over)).first()[column] == want


def test_total_counts_a_missing_band_as_zero(spark):
    r = agents.scores(summaries(spark, daily_trading_consistency=1.5)).first()
    assert r.trading_consistency_score is None and r.total_score == 200 + 200 + 35 + 200


def test_recency_against_a_common_day(spark):
    assert agents.scores(summaries(spark)).first().recency_in_months_score == 200
    assert agents.scores(summaries(spark), "2024-06-30").first().recency_in_months_score == 0


@pytest.mark.parametrize("loans, repaid, want", [
    ("Band 1", None, 0.119), ("Band 2", "Band 3", 0.0), ("Band 2", "Band 4", 0.083), ("Band 5", "Band 6", 0.17), ("Band 3", None, 0.0)])
def test_limit_matrix(spark, loans, repaid, want):
    df = spark.createDataFrame([(loans, repaid)], "l string, r string")
    assert df.select(agents.limit_factor("l", "r")).first()[0] == want


def history(spark, legacy=False):
    clients = spark.createDataFrame([("a", 1), ("b", 2)], "agent_id string, client_id int")
    loans = spark.createDataFrame([(10, 1, 100.0, D(2024, 1, 1), D(2024, 1, 4)), (11, 1, 100.0, D(2024, 1, 20), D(2024, 1, 23))],
                                  "loan_id int, client_id int, principal double, disbursed_on date, matures_on date")
    # Nine days after maturity is too late; the day before is not.
    paid = spark.createDataFrame([(10, D(2024, 1, 12), 90.0), (10, D(2024, 1, 13), 50.0), (11, D(2024, 1, 25), 40.0)], "loan_id int, paid_on date, amount double")
    return agents.loan_history(clients, loans, paid, AS_OF, legacy)


def test_hurdle_rate(spark):
    r = history(spark).collect()
    assert [(x.agent_id, x.count_of_loans, x.percentage_repayment_in_time) for x in r] == [("a", 2, 65.0)]
    assert history(spark, legacy=True).first().percentage_repayment_in_time == 100.0


def limited(spark, debit, hist=None):
    scored = spark.createDataFrame([("a", debit)], "agent_id string, average_daily_debit_amt double")
    hist = hist or spark.createDataFrame([], "agent_id string, client_id int, count_of_loans long, months_since_last_disbursement double, "
                                             "total_principal double, repayments_in_time double, percentage_repayment_in_time double")
    return agents.limits(scored, hist).first()


def test_first_loan_gets_half_but_not_below_the_minimum(spark):
    assert limited(spark, 60000.0).current_limit == 107100.0      # 60000 * 30 * 0.119 = 214200, halved
    assert limited(spark, 15000.0).current_limit == 35000.0       # half of 53600 is below the minimum
    assert limited(spark, 5000.0).current_limit == 0.0


def test_open_band_edges_have_no_gap(spark):
    row = lambda p: spark.createDataFrame([("a", 1, 2, 0.5, 1.0, 1.0, p)], "agent_id string, client_id int, count_of_loans long, "
                                          "months_since_last_disbursement double, total_principal double, repayments_in_time double, percentage_repayment_in_time double")
    assert limited(spark, 60000.0, row(69.5)).repayment_band == "Band 3"
    scored = spark.createDataFrame([("a", 60000.0)], "agent_id string, average_daily_debit_amt double")
    assert agents.limits(scored, row(69.5), legacy=True).first().repayment_band is None


@pytest.mark.parametrize("now, before, two, held, final", [
    (0.0, 90.0, 0.0, 0.0, 0.0), (100.0, 0.0, 0.0, 100.0, 100.0), (200.0, 100.0, 100.0, 150.0, 150.0), (110.0, 100.0, 100.0, 100.0, 100.0),
    (120.0, 100.0, 100.0, 120.0, 120.0), (80.0, 100.0, 50.0, 80.0, 100.0), (130.0, 100.0, 200.0, 130.0, 100.0), (50.0, 100.0, 200.0, 50.0, 50.0)])
def test_stabilisation(spark, now, before, two, held, final):
    cur = spark.createDataFrame([("a", now)], "agent_id string, current_limit double")
    past = spark.createDataFrame([("a", before, before, two)], "agent_id string, previous_limit double, previous_m_limit double, previous_2m_limit double")
    r = agents.stabilise(cur, past).first()
    assert (r.limit_after_stabilisation, r.final_limit) == (held, final)


def test_earlier_limit_needs_the_largest_id_too(spark, rows):
    v = lambda day: f"m7[2022-11-05, {day}]"
    df = spark.createDataFrame([("a", v("2023-11-01"), 1, 10.0), ("a", v("2023-12-01"), 2, 20.0), ("a", v("2024-01-30"), 3, 30.0),
                                ("b", v("2023-12-01"), 1, 40.0), ("b", v("2023-11-01"), 2, 50.0), ("c", v("2024-01-30"), 9, 1.0)],
                               "agent_id string, model_version string, result_id int, `limit` double")
    assert rows(agents.earlier_limits(df, AS_OF)) == [("a", 30.0, 20.0, 10.0), ("b", 40.0, None, None), ("c", 1.0, None, None)]


def test_reason_names_no_lender_but_ours(spark):
    df = spark.createDataFrame([("a", 0.0, 500, 0, 100, 100, 100, 100, 0.1)], "agent_id string, final_limit double, total_score int, trading_consistency_score int, "
                               "average_daily_debit_score int, age_on_network_score int, recency_in_months_score int, unique_number_of_commissions_score int, limit_factor double")
    r = agents.qualify(df, lender="Example Bank").first()
    assert not r.is_qualified and r.reason_code == " C004" and "Example Bank lending criteria" in r.communication


def salaries(spark, rows):
    return spark.createDataFrame(rows, "client_id string, paid_at timestamp_ntz, amount double, account string, bank string, created_at timestamp_ntz, is_government boolean, is_multinational boolean")


def pay(client, day, amount, gov=False, mnc=False, created=None):
    at = T.combine(day, dt.time(8))
    return (client, at, amount, "acc", "bank", created or at, gov, mnc)


def test_salary_summary(spark):
    data = [pay("g", D(2024, m, 5), 100.0 * m, gov=True) for m in range(1, 10)]
    data += [pay("g", D(2024, 9, 5), 30.0, gov=True, created=T(2024, 9, 4)), pay("g", D(2023, 12, 31), 999.0, gov=True)]
    data += [pay("p", D(2024, 9, 3), 100.0), pay("p", D(2024, 9, 3), 100.0, created=T(2024, 9, 9)), pay("p", D(2024, 3, 31), 5.0)]
    out = {r.client_id: r for r in salary.salary_summary(salaries(spark, data), "2024-09-30").collect()}
    g, p = out["g"], out["p"]
    # Of two payments on one day one counts, but not in the six-month mean.
    assert (g.count_of_payments_long, g.sum_of_payments_long, g.months_in_period) == (9, 4500.0, 9)
    assert g.average_monthly_long == 500.0 and g.average_monthly_6m == pytest.approx((4 + 5 + 6 + 7 + 8 + 9) * 100 / 6 + 5)
    assert (g.latest_amount_long, g.minimum_payment_long, g.count_of_payments_3m, g.average_monthly_3m) == (900.0, 100.0, 3, 800.0)
    assert g.is_qualified_on_salaries and g.is_government
    # A copy of a payment is no second payment; months before the window are cut.
    assert (p.count_of_payments_long, p.sum_of_payments_long, p.months_in_period) == (1, 100.0, 6)
    assert not p.is_qualified_on_salaries and not p.payday_is_qualified_on_salaries


def test_clients_without_salary_get_defaults(spark):
    summary = salary.salary_summary(salaries(spark, [pay("p", D(2024, 9, 3), 100.0)]), "2024-09-30")
    clients = spark.createDataFrame([("p",), ("q",)], "client_id string")
    q = {r.client_id: r for r in salary.with_defaults(clients, summary, "2024-09-30").collect()}["q"]
    assert (q.count_of_payments_long, q.latest_payment_long, q.is_government, q.months_in_period) == (0, D(2024, 9, 30), False, 6)


def test_zero_salary_counts_as_full_debt(spark):
    summary = salary.salary_summary(salaries(spark, [pay("p", D(2024, 9, 3), 0.0)]), "2024-09-30")
    debts = spark.createDataFrame([("p", "l", T(2024, 1, 1), "open", 10.0, 5.0, 2.0, T(2024, 1, 1))] * 2,
                                  "client_id string, lender string, disbursed_at timestamp_ntz, status string, loan_amount double, outstanding double, repayment double, created_at timestamp_ntz")
    r = salary.debt_and_limits(summary, debts).first()
    assert (r.debt_share, r.total_debt_value, r.count_of_running_loans, r.limit_6m) == (1.0, 2.0, 1, 0.0) and not r.is_qualified


@pytest.mark.parametrize("gap, age, closed, want", [(45, 60, True, True), (46, 60, True, False), (45, 59, True, False), (45, 60, False, False)])
def test_tenure_rules(spark, gap, age, closed, want):
    today = D(2024, 6, 30)
    last = today - dt.timedelta(days=age)
    day = lambda d: d + dt.timedelta(days=30)
    prev = last - dt.timedelta(days=gap)
    loans = spark.createDataFrame([(1, "c", 18, prev, day(prev), day(prev)), (2, "c", 18, last, day(last) if age >= 30 else today, day(last) if closed else None)],
                                  "loan_id int, client_id string, product_id int, disbursed_on date, matures_on date, closed_on date")
    clients = spark.createDataFrame([("c",), ("none",)], "client_id string")
    got = {r.client_id: r.passes for r in salary.tenure_rules(clients, loans, today).collect()}
    assert got == {"c": want, "none": False}


def test_a_first_six_month_loan_is_enough(spark):
    loans = spark.createDataFrame([(1, "c", 19, D(2024, 1, 1), D(2024, 2, 1), None), (2, "c", 18, D(2024, 3, 1), D(2024, 4, 1), None)],
                                  "loan_id int, client_id string, product_id int, disbursed_on date, matures_on date, closed_on date")
    assert salary.tenure_rules(loans.select("client_id"), loans, D(2024, 6, 30)).first().passes


REPORT = """{"ConsumerHitResponse": {"BODY": {
  "ClassificationInsType": [{"AMOUNT_OVERDUE": "1,200.00", "INSTITUTION_TYPE": "bank"}, {"AMOUNT_OVERDUE": "0", "INSTITUTION_TYPE": "micro"}],
  "ClassificationProdType": [{"AMOUNT_OVERDUE": " 1,200.00", "PRODUCT_TYPE": "loan"}],
  "CreditFacilityHistory24": [{"ACCOUNT_NUMBER": "1", "AMOUNT_OVERDUE_CAL": "1,200.00", "NUM_OF_DAYS_IN_ARREARS_CAL": "59", "INSTITUTION_NAME": "First"},
                              {"ACCOUNT_NUMBER": "2", "AMOUNT_OVERDUE_CAL": "0", "NUM_OF_DAYS_IN_ARREARS_CAL": "0", "INSTITUTION_NAME": "Other"}]}}}"""


def test_bureau_rules(spark):
    reports = spark.createDataFrame([("a", T(2024, 1, 1), "{}"), ("a", T(2024, 2, 1), REPORT), ("b", T(2024, 1, 1), '{"ConsumerHitResponse": {"BODY": {}}}')],
                                    "client_id string, created_at timestamp, report string")
    features = bureau_rules.report_features(reports, ["First"])
    a = features.filter("client_id = 'a'").first()
    assert (a.total_no_of_facilities, a.total_overdue_amount, a.maximum_days_in_arrears, a.no_of_institution_types, a.at_deposit_bank) == (2, 1200.0, 59, 2, True)
    summary = spark.createDataFrame([("a", 1200.0, 1201.0), ("b", 1.0, 1.0), ("c", 0.0, 0.0)], "client_id string, average_monthly_6m double, average_monthly_3m double")
    got = {r.client_id: (r.bureau_qualified, r.payday_bureau_qualified) for r in bureau_rules.bureau_rules(summary, features).collect()}
    assert got == {"a": (False, True), "b": (False, False), "c": (True, True)}
    assert [tuple(r) for r in bureau_rules.product_overdue(reports).collect()] == [("a", "loan", 1200.0)]
