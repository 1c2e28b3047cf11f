import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import similarity
from ledgerloom.plans import bureau_submission as submission, kyc, limits, monitoring, recon, reports

T, D = dt.datetime, dt.date
TODAY = D(2024, 6, 30)


def book(spark, **over):
    base = dict(loan_id=1, loan_status=300, total_outstanding=100.0, partner_balance=None, partner_balance_date=None,
                disbursed_on=D(2024, 1, 1), matures_on=D(2024, 2, 1), closed_on=None)
    base.update(over)
    return spark.createDataFrame([tuple(base.values())], "loan_id int, loan_status int, total_outstanding double, partner_balance double, "
                                                         "partner_balance_date date, disbursed_on date, matures_on date, closed_on date")


def record(spark, since=None, **over):
    paid = spark.createDataFrame([(1, 5, D(2024, 1, 9), 10.9, 2), (1, 9, D(2024, 1, 8), 99.0, 1)], "loan_id int, transaction_id int, transaction_date date, amount double, transaction_type int")
    plan = spark.createDataFrame([(1, 1, D(2024, 1, 15), 1, 50.0, None), (1, 2, D(2024, 1, 20), 0, 50.0, 5.0), (1, 3, D(2024, 12, 1), 0, 50.0, 5.0)],
                                 "loan_id int, installment int, due_date date, completed int, principal_amount double, interest_amount double").withColumns(
        {"fee_amount": F.lit(None).cast("double"), "penalty_amount": F.lit(1.0)})
    late = spark.createDataFrame([(1, since, 40.0)] if since else [], "loan_id int, overdue_since date, total_overdue double")
    return submission.loan_records(book(spark, **over), paid, plan, late, TODAY).first()


@pytest.mark.parametrize("days, grade, status", [(0, "A", "F"), (1, "B", "F"), (30, "B", "F"), (31, "C", "F"), (60, "C", "F"), (61, "D", "E"), (90, "D", "E"), (91, "E", "E")])
def test_arrears_classes(spark, days, grade, status):
    r = record(spark, since=TODAY - dt.timedelta(days=days))
    assert (r.days_in_arrears, r.classification, r.account_status) == (days, grade, status)


def test_record_children(spark):
    r = record(spark)
    assert (r.last_payment_date, r.last_payment_amount, r.instalment_amount) == (D(2024, 1, 9), 10.0, 51.0)
    assert (r.next_instalment_date, r.instalments_in_arrears, r.account_status_date) == (D(2024, 1, 20), 1, D(2024, 1, 1))


@pytest.mark.parametrize("balance, day, want", [(70.0, D(2024, 6, 29), 70.0), (70.0, D(2024, 6, 28), 100.0), (0.0, D(2020, 1, 1), 0.0), (None, None, 100.0), (-5.0, D(2024, 6, 29), 0.0)])
def test_partner_balance_counts_while_fresh(spark, balance, day, want):
    assert record(spark, partner_balance=balance, partner_balance_date=day).current_balance == want


def test_settled_loans_have_no_arrears(spark):
    r = record(spark, since=D(2024, 1, 1), total_outstanding=0.0, loan_status=600, closed_on=D(2024, 3, 3))
    assert (r.days_in_arrears, r.overdue_balance, r.instalments_in_arrears, r.overdue_date) == (0, 0.0, 0, None)
    assert (r.classification, r.account_status, r.account_status_date) == ("A", "A", D(2024, 3, 3))


def to_clean(spark, **over):
    base = dict(loan_id=1, surname="O'Hara", forename_1="ann", forename_2="Lee", gender="F", id_number="12-34", date_of_birth=D(1990, 1, 1), mobile_number="254_x",
                original_amount=1500.0, current_balance=200.5, overdue_balance=300.0, instalment_amount=10.0, last_payment_amount=0.0, days_in_arrears=3,
                instalments_in_arrears=1, classification="B", account_status="F", account_status_date=D(2024, 5, 1), overdue_date=None,
                disbursement_date=D(2024, 1, 1), repayment_period="1")
    base.update(over)
    return spark.createDataFrame([tuple(base.values())], "loan_id int, surname string, forename_1 string, forename_2 string, gender string, id_number string, date_of_birth date, "
                                 "mobile_number string, original_amount double, current_balance double, overdue_balance double, instalment_amount double, last_payment_amount double, "
                                 "days_in_arrears int, instalments_in_arrears int, classification string, account_status string, account_status_date date, overdue_date date, "
                                 "disbursement_date date, repayment_period string")


def test_clean_record(spark):
    good, small, bad = submission.clean_records(to_clean(spark), TODAY)
    r = good.first()
    assert (r.surname, r.forename_1, r.id_number, r.id_type, r.mobile_number) == ("Ohara", "Ann", "1234", "001", "254")
    assert (r.current_balance, r.overdue_balance, r.last_payment_amount, r.overdue_date) == ("20050", "20050", "000", D(2024, 5, 1))
    assert small.count() == 0 and bad.count() == 0


def test_short_surname_falls_back_and_passport_keeps_its_form(spark):
    r = submission.clean_records(to_clean(spark, surname="x", id_number="P-1"), TODAY)[0].first()
    assert (r.surname, r.forename_3, r.id_type, r.id_number) == ("Lee", "Lee", "002", "P-1")


def test_missing_fields_are_listed_per_column(spark):
    good, _, bad = submission.clean_records(to_clean(spark, surname=None, forename_2="J", gender=None), TODAY)
    assert good.count() == 0 and sorted(r.exception_column for r in bad.collect()) == ["gender", "surname"]
    assert submission.clean_records(to_clean(spark, gender=None, current_balance=0.0), TODAY)[2].count() == 0


def test_small_amounts_are_held_back_unless_settled(spark):
    good, small, _ = submission.clean_records(to_clean(spark, original_amount=999.0), TODAY)
    assert good.count() == 0 and small.count() == 1
    good, small, _ = submission.clean_records(to_clean(spark, original_amount=999.0, current_balance=0.0), TODAY)
    assert good.count() == 1 and small.count() == 0


def test_whitelist_changes(spark):
    columns = "store_number string, blacklist_flag int, limit_1 double, limit_7 double, limit_21 double"
    old = spark.createDataFrame([("1.0", 0, 10.0, 0.0, 0.0), ("2", 0, 10.0, 0.0, 0.0), ("3", 1, 5.0, 5.0, 5.0), ("004", 0, 1.0, 1.0, 1.0), ("5", 0, 1.0, 1.0, 1.0), (None, 0, 1.0, 1.0, 1.0)], columns)
    new = spark.createDataFrame([("1", "v2", 0, 20.0, 0.0, 0.0), ("2", "v2", 0, 10.0, 0.0, 0.0), ("3", "v2", 0, 5.0, 4.0, 5.0), ("4", "v2", 0, 1.0, 1.0, 1.0), ("6", "v2", 0, 0.0, 0.0, 9.0), ("None", "v2", 0, 0.0, 0.0, 9.0), ("7", "v1", 0, 0.0, 0.0, 9.0)],
                                "store_number string, model_version string, blacklist_flag int, limit_1 double, limit_7 double, limit_21 double")
    got = {r.store_number: r for r in limits.whitelist_changes(old, new, "v2").collect()}
    assert {k: r.action for k, r in got.items()} == {"1": "update", "2": "unchanged", "3": "update", "004": "zeroise", "5": "zeroise", "6": "insert"}
    assert got["1"].limit_1_change == "positive" and got["3"].blacklist_flag_change == "whitelist" and got["3"].has_negative_limit_7_change == 1
    assert got["6"].has_limit_21 == 1 and got["6"].has_limit_21_change == 0


def test_contract_match_amount_or_amount_less_fee(spark, rows):
    txn = spark.createDataFrame([(1, "k1", 100.0, 5.0), (2, "k1", 105.0, 5.0), (3, "k1", 101.0, 5.0), (4, None, 100.0, 5.0)], "surrogate_id int, loan_contract_id string, amount double, fee double").withColumns(
        {"is_disbursement": F.lit(True), "status": F.lit("Completed")})
    contracts = spark.createDataFrame([("k1", 100.0, 5.0, "10002", "i")], "contract_id string, principal double, access_fee double, product_code string, identity string")
    assert rows(recon.contract_match(txn, contracts), "surrogate_id") == [(1,), (2,)]


def test_statement_principal_is_grossed_up(spark, rows):
    df = spark.createDataFrame([(i, "r", "Completed", "Disbursement to 77 - Shop", kind, -99.52, "p", T(2024, 1, 1)) for i, kind in enumerate(["1 day", "21 day", "30 day", "Fee x"])],
                               "statement_id int, receipt_number string, transaction_status string, details string, reason_type string, withdrawn double, other_party string, completed_at timestamp_ntz")
    already = spark.createDataFrame([(9,)], "warehouse_key int")
    got = {r.loan_term: (r.loan_principal, r.store_number) for r in recon.statement_disbursements(df, already, T(2023, 1, 1)).collect()}
    assert got["1"] == (100.0, "77") and got["21"][0] == pytest.approx(109.5070) and got["30"][0] == -99.52 and "Fee" not in got


def test_feedback_fills_pending_rows_only(spark):
    dump = spark.createDataFrame([("a", None, None), ("b", "400", None), ("c", "200", None), ("d", "400", "kept")], "shop string, status_code string, failure_reason string")
    posted = spark.createDataFrame([(s, c, r, 1) for s in "abcd" for c, r in [("400", "late"), ("200", None), (None, None)]] + [("a", "100", "no key", None)],
                                   "shop string, status_code string, failure_reason string, warehouse_key int")
    got = {r.shop: (r.status_code, r.failure_reason) for r in recon.feedback(dump, posted, "shop").collect()}
    assert got == {"a": ("200", None), "b": ("200", None), "c": ("200", None), "d": ("400", "kept")}


def test_backfill_lists_past_months_that_differ(spark, rows):
    report = spark.createDataFrame([(2023, 12, 1, 0), (2024, 5, 0, 0), (2024, 6, 3, 0), (2024, 4, 0, 2)], "year int, month int, diff_a int, diff_b int")
    assert rows(monitoring.backfill_months(report, TODAY)) == [(2023, 12), (2024, 4)]


def test_posting_summary_has_every_day(spark):
    core = spark.createDataFrame([(1, T(2024, 6, 29, 5), 10.0, "disbursement"), (2, T(2024, 6, 29, 6), 20.0, "repayment"), (3, T(2020, 1, 1), 5.0, "repayment")], "receipt_number int, created_at timestamp_ntz, amount double, kind string")
    feed = spark.createDataFrame([(1, "200", "disbursement", 11.0)], "receipt_number int, status_code string, kind string, amount double")
    out = reports.posting_summary(spark, core, feed, feed.filter("false"), TODAY)
    assert out.count() == 31
    r = out.filter("day = '2024-06-29'").first()
    assert (r.disbursement_volume_feed_ok, r.disbursement_value_feed_ok, r.repayment_volume_manual_missing_in_both, r.repayment_value_manual_missing_in_both) == (1, 11.0, 1, 20.0)


def test_repeated_receipts_count_like_joined_rows(spark):
    """Merged sources give what joining every copy would give."""
    core = spark.createDataFrame([(1, T(2024, 6, 29), 10.0, "repayment"), (1, T(2024, 6, 29), 1.0, "repayment")], "receipt_number int, created_at timestamp_ntz, amount double, kind string")
    feed = spark.createDataFrame([(1, "400", "repayment", 2.0)] * 3 + [(1, "200", "repayment", None)], "receipt_number int, status_code string, kind string, amount double")
    dump = spark.createDataFrame([(1, "200", "repayment", 5.0)] * 2 + [(1, "400", "repayment", 7.0)], "receipt_number int, status_code string, kind string, amount double")
    r = reports.posting_summary(spark, core, feed, dump, TODAY).filter("day = '2024-06-29'").first()
    joined = reports.provenance(core, feed, dump)
    bad = (F.col("feed_kind") == "repayment") & (F.col("feed_status") == "400")
    want = joined.agg(
        F.count(F.when(bad, F.col("feed_amount"))).alias("n"), F.sum(F.when(bad, F.col("feed_amount"))).alias("s"),
        F.sum(F.when(bad & (F.col("dump_status") == "200"), F.col("dump_amount"))).alias("d"),
        F.sum(F.when(bad & (F.col("dump_status") == "400"), F.col("amount"))).alias("c"), F.count(F.when(F.col("feed_status") == "200", F.col("feed_amount"))).alias("ok")).first()
    assert (r.repayment_volume_feed_failed, r.repayment_value_feed_failed, r.repayment_value_dump_ok_failed_in_feed, r.repayment_value_manual_failed_in_both, r.repayment_volume_feed_ok) == tuple(want)


def test_kyc_batches_are_exclusive(spark):
    names = [
        ("1", "1", D(2024, 1, 1), "john kamau", "mary wanjiku", "mary wanjiku"),    # operations and registry agree
        ("2", None, D(2024, 1, 1), "john kamau", "mary wanjiku njeri", "mary wanjeri njoki"),
        ("3", "3", D(2024, 1, 1), "mary wanjiku", "best hardware shop", "mary atieno"),
        ("4", "4", D(2024, 1, 1), "mary wanjiku", "best hardware", "wanjiku mary"),
        ("5", "5", D(2024, 1, 1), "mary wanjiku", "wanjiku mary", "mary wanjiku"),
        ("6", "6", D(2024, 1, 1), "mary", "shop 24", "mary"),                        # digits: left out
        ("1", "1", D(2023, 1, 1), "x", "y", "z"),                                    # older opt-in day
        ("7", "7", D(2024, 1, 1), "mary", "mary 9", "mary"), ("7", "7", D(2023, 1, 1), "abcd", "wxyz", "wxyz"),  # newest has digits: the older row is for the last batch only
    ]
    df = spark.createDataFrame(names, "national_id string, ops_id string, opt_in_date date, own_name string, ops_name string, registry_name string")
    got = [(r.national_id, r.batch) for r in kyc.triage(df).collect()]
    assert len(got) == len({k for k, _ in got})
    batches = dict(got)
    assert batches["1"] == "update_exact" and batches["3"] == "names_swapped" and batches["4"] == "keep_id_match" and batches["5"] == "keep_all_exact" and "6" not in batches
    assert batches["7"] == "consult"


def test_each_pair_of_names_is_compared_once(spark, plan):
    rows = [(i, a, b, c) for i in range(20) for a, b, c in [("mary wanjiku", "mary wanjeri", "wanjiku m"), ("mary wanjeri", "mary wanjiku", None), (None, "x", "x"), ("", "é", "É")]]
    df = spark.createDataFrame(rows, "i int, own_name string, ops_name string, registry_name string")
    out = kyc.name_scores(df)
    assert "HashAggregate(keys=[_x" in plan(out)
    want = similarity.with_token_scores(df, {"own_ops": ("own_name", "ops_name"), "own_registry": ("own_name", "registry_name"), "ops_registry": ("ops_name", "registry_name")})
    assert out.columns == want.columns and sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    assert sum(r.ops_registry == 100 for r in out.collect()) == 40


def test_gender_and_term(spark):
    df = spark.createDataFrame([("Male", "Female"), (None, "x"), ("Male", None)], "own string, registry string")
    assert [r[0] for r in df.select(submission.gender_code(F.col("own"), F.col("registry"))).collect()] == ["F", None, "M"]
    terms = spark.createDataFrame([(30, 0), (6, 2), (1, 9)], "n int, unit int")
    assert [r[0] for r in terms.select(submission.term_months(F.col("n"), F.col("unit"))).collect()] == [1, 6, None]


def test_provenance_pairs_are_made_last(spark):
    """One receipt with 10,000 feed and 10,000 dump rows: 20,000 entries in lists until the pairs are wanted."""
    core = spark.createDataFrame([("R1", 5), ("R2", 6), (None, 7)], "receipt_number string, k int")
    many = lambda n, side: spark.range(n).selectExpr("'R1' as receipt_number", "cast(200 as string) as status_code", f"'{side}' as kind", "cast(id as decimal(12,2)) as amount")
    lists = reports.traced(core, many(10_000, "f"), many(10_000, "d")).filter("receipt_number = 'R1'")
    sizes = lists.agg(F.count("*"), F.max(F.size("_f_rows")), F.max(F.size("_d_rows")), F.sum(F.size("_f_rows").cast("long") * F.size("_d_rows"))).first()
    assert sizes[0] <= 100 and sizes[1] < 1300 and sizes[2] < 1300 and sizes[3] == 10_000 * 10_000


def test_provenance_is_the_plain_join(spark, rows):
    core = spark.createDataFrame([("R1", 5), ("R1", 5), ("R2", 6), ("R3", 7), (None, 8)], "receipt_number string, k int")
    schema = "receipt_number string, status_code string, kind string, amount decimal(12,2)"
    feed = spark.createDataFrame([("R1", "200", "a", 1), ("R1", "200", "a", 1), ("R1", "400", None, None), ("R2", "200", "b", 3), (None, "200", "b", 3)], schema.replace("decimal(12,2)", "int"))
    dump = spark.createDataFrame([("R1", "200", "x", 2), ("R1", "200", "x", 2), ("R3", None, "x", 9), (None, "200", "b", 3)], schema.replace("decimal(12,2)", "int"))
    f = feed.toDF("_f", "feed_status", "feed_kind", "feed_amount")
    d = dump.toDF("_d", "dump_status", "dump_kind", "dump_amount")
    plain = core.join(f, F.col("receipt_number") == F.col("_f"), "left").join(d, F.col("receipt_number") == F.col("_d"), "left").withColumns({
        "missing_in_feed": F.col("_f").isNull(), "missing_in_dump": F.col("_f").isNull() & F.col("_d").isNull()})
    got = reports.provenance(core, feed, dump)
    assert got.columns == plain.columns and rows(got) == rows(plain) and got.count() == 2 * 3 * 2 + 3


def test_months_are_reloaded_in_place(spark, tmp_path, rows):
    path = tmp_path / "t"
    day = lambda m, i: D(2024, m, 1 + i)
    core = spark.createDataFrame([(m * 100 + i, day(m, i), float(i), 1, 0) for m in range(1, 7) for i in range(5)], "id int, paid_on date, amount double, transaction_type int, penalty int")
    stored = core.filter("id not in (201, 603)").withColumn("amount", F.when(F.col("id") == 402, 99.0).otherwise(F.col("amount")))
    stored.withColumns({"year": F.year("paid_on"), "month": F.month("paid_on")}).write.partitionBy("year", "month").parquet(str(path))
    files = lambda: {p.parent.name: p.name for p in path.rglob("*.parquet")}
    before = files()
    held = spark.read.parquet(str(path))
    report = monitoring.transactions(*(df.withColumn("transaction_date", F.col("paid_on")) for df in (core, held)))
    monitoring.reload_months(core, report, str(path), "paid_on", D(2024, 6, 20))
    after = files()
    assert {m for m in before if before[m] != after[m]} == {"month=2", "month=4"} and set(after) == set(before)
    now = spark.read.parquet(str(path)).select("id", "paid_on", "amount")
    assert rows(now) == rows(core.select("id", "paid_on", "amount").filter("id <> 603"))  # the current month waits
