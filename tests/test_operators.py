import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregate, dedupe, extract, ingest, joins, merge
from ledgerloom.operators.slices import Slices

D = dt.date
T = dt.datetime


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows carry one key, and many of them are copies."""
    random.seed(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{random.randint(0, 200)}"
        data.append((i, key, D(2024, 1, 1) + dt.timedelta(days=random.randint(0, 120)), random.randint(0, 9)))
    return data, spark.createDataFrame(data, "id int, key string, day date, v int").repartition(8)


def test_latest_per_key_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 2, 1), ("a", 2, 2), ("a", 1, 3), ("b", 1, 4), (None, 5, 5)], "k string, t int, id int")
    assert rows(dedupe.latest_per_key(df, "k", F.col("t").desc()), "id") == [(1,), (2,), (4,), (5,)]
    assert rows(dedupe.latest_per_key(df, "k", [F.col("t").desc(), F.col("id")], ties="one"), "id") == [(1,), (4,), (5,)]


def test_latest_per_key_on_a_hot_key(skewed, rows, plan):
    data, df = skewed
    out = dedupe.latest_per_key(df, "key", F.col("day").desc())
    best = {}
    for _, k, day, _ in data:
        best[k] = max(best.get(k, day), day)
    assert rows(out, "id") == sorted((i,) for i, k, day, _ in data if day == best[k])
    assert plan(out).count("WindowGroupLimit") == 2


def test_pick_per_key_needs_no_window(skewed, rows, plan):
    data, df = skewed
    out = dedupe.pick_per_key(df, ["key"], ["day", "id"])
    best = {}
    for i, k, day, v in data:
        best[k] = max(best.get(k, (day, i, v)), (day, i, v))
    assert rows(out, "key", "id") == sorted((k, b[1]) for k, b in best.items())
    assert "Window" not in plan(out)


@pytest.mark.parametrize("ties", ["one", "all"])
def test_exact_duplicates(skewed, rows, ties):
    data, df = skewed
    out = dedupe.drop_exact_duplicates(df.select("key", "v", "day"), ["key", "v"], ["day"], ties=ties)
    best = {}
    for _, k, day, v in data:
        best[k, v] = max(best.get((k, v), day), day)
    want = [(k, v, best[k, v]) for _, k, day, v in data if day == best[k, v]]
    assert rows(out) == sorted(set(want) if ties == "one" else want)


def test_exact_duplicates_treat_nulls_as_equal(spark, rows):
    df = spark.createDataFrame([(None, 1, 10), (None, 1, 11), ("a", None, 12), ("a", None, 12)], "k string, v int, t int")
    assert rows(dedupe.drop_exact_duplicates(df, ["k", "v"], ["t"], ties="all"), "t") == [(11,), (12,), (12,)]
    assert rows(dedupe.drop_exact_duplicates(df, ["k", "v"], ["t"], ties="one"), "t") == [(11,), (12,)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("keys", [["key"], []])
def test_sliced_numbers_equal_plain_numbers(skewed, rows, keys, descending):
    data, df = skewed
    sliced = dedupe.number_in_group(df, keys, ["day", "id"], "n", slice_by=F.trunc("day", "MM"), descending=descending)
    want, seen = [], {}
    for i, k, day, _ in sorted(data, key=lambda r: (r[2], r[0]), reverse=descending):
        group = k if keys else ""
        seen[group] = seen.get(group, 0) + 1
        want.append((i, seen[group]))
    assert rows(sliced, "id", "n") == sorted(want)
    for n in (None, 2, 50):
        by_ranges = dedupe.number_in_group(df, keys, ["day", "id"], "n", slice_by=Slices(df, "day", n), descending=descending)
        assert by_ranges.columns == [*df.columns, "n"] and rows(by_ranges, "id", "n") == sorted(want)


def test_report_numbers_need_no_job_to_plan(spark, skewed):
    """The edges are a subquery of the plan: nothing runs before the report does, and nothing caps the slices."""
    _, df = skewed
    tracker, group = spark.sparkContext.statusTracker(), "plans-only"
    spark.sparkContext.setJobGroup(group, "planning")
    out = dedupe.number_in_group(df, [], ["id"], "n", slice_by=Slices(df, "id", 1000))
    assert tracker.getJobIdsForGroup(group) == []
    spark.sparkContext.setJobGroup("", "")
    assert [r["n"] for r in out.orderBy("id").select("n").collect()] == list(range(1, df.count() + 1))


def test_average_rank_matches_pandas(skewed, rows):
    data, df = skewed
    import pandas as pd
    pdf = pd.DataFrame(data, columns=["id", "key", "day", "v"])
    pdf["r"] = pdf.groupby("key")["v"].rank()
    for n in (None, 2, 40):
        assert rows(dedupe.average_rank(df, "key", "v", slices=n), "id", "avg_rank") == sorted(zip(pdf.id, pdf.r))


def test_average_rank_spreads_a_key_that_most_rows_have(spark):
    data = [(i, "hot" if i % 10 else f"k{i}", (i * 7919) % 9973) for i in range(9000)]
    df = spark.createDataFrame(data, "id int, key string, v int")
    at = Slices(df, "v")
    sizes = at.on(df).groupBy("key", at.below("v")).count().agg(F.max("count"), F.sum("count")).first()
    assert sizes[0] < sizes[1] / 20
    values = sorted(v for _, k, v in data if k == "hot")
    got = dedupe.average_rank(df, "key", "v").filter("key = 'hot'").orderBy("v").select("avg_rank").collect()
    assert [r[0] for r in got] == [k + 1.0 for k in range(len(values))]


def test_first_two(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 5)], "k string, t int")
    got = {r.k: (r.n_rows, r.t_1, r.t_2) for r in dedupe.first_two(df, "k", [F.col("t").desc()], ["t"]).collect()}
    assert got == {"a": (2, 3, 2), "b": (1, 5, None)}


def test_uniquify(spark):
    df = spark.createDataFrame([(1, "p", D(2024, 1, 1)), (2, "p", D(2024, 1, 1)), (3, "q", D(2024, 1, 1)), (4, None, D(2024, 1, 1))], "id int, phone string, day date")
    known = spark.createDataFrame([(" q ",), (None,)], "phone string")
    got = {r.id: r.phone for r in dedupe.uniquify(df, "phone", "day", ["id"], known, "phone").collect()}
    assert got == {1: "p", 2: "p_2024-01-01_2", 3: "q_2024-01-01", 4: None}


def test_dense_rank_keeps_all_best(spark, rows):
    df = spark.createDataFrame([("a", 200, 1), ("a", 400, 2), ("a", 200, 3), ("b", None, 4)], "k string, s int, id int")
    assert rows(dedupe.best_status_per_key(df, "k", "s"), "id") == [(1,), (3,), (4,)]


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("by", [["key"], []])
def test_asof_join_matches_brute_force(spark, skewed, rows, strict, by):
    data, df = skewed
    random.seed(5)
    marks = [(random.choice(["hot", "k1", "k2", "k3"]), D(2024, 1, 1) + dt.timedelta(days=random.randint(0, 120)), f"v{i}") for i in range(60)]
    right = spark.createDataFrame(marks, "key string, end date, version string")
    right = right if by else right.drop("key")

    def want(k, day):
        hits = [(e, v) for mk, e, v in marks if (not by or mk == k) and (e < day if strict else e <= day)]
        return max(hits)[1] if hits else None

    for slices in (None, 2, 7, 300):
        out = joins.asof_join(df, right, "day", "end", "version", by=by, strict=strict, slices=slices)
        assert out.columns == [*df.columns, "version"]
        assert rows(out, "id", "version") == sorted((i, want(k, day)) for i, k, day, _ in data)


@pytest.mark.parametrize("strict", [True, False])
def test_asof_join_spreads_a_day_that_most_rows_have(spark, rows, plan, strict):
    hot = D(2024, 3, 10)
    data = [(i, hot if i % 10 else D(2024, 3, 1) + dt.timedelta(days=i // 10 % 20)) for i in range(4000)] + [(4000, None), (4001, None)]
    marks = [(D(2024, 3, 1) + dt.timedelta(days=3 * i), f"v{i}") for i in range(7)] + [(None, "no day"), (hot, "at hot"), (D(2024, 3, 4), None)]
    left, right = spark.createDataFrame(data, "id int, day date"), spark.createDataFrame(marks, "end date, version string")

    def want(day):
        hits = [(e, v) for e, v in marks if v and e and day and (e < day if strict else e <= day)]
        return max(hits)[1] if hits else None
    out = joins.asof_join(left, right, "day", "end", "version", strict=strict)
    assert rows(out, "id", "version") == sorted((i, want(day)) for i, day in data)
    at = Slices(left, "day")
    sizes = [r["count"] for r in at.on(left.filter("day is not null")).groupBy(at.dealt("day", F.xxhash64("id", "day"))).count().collect()]
    assert len(sizes) > at.n / 2 and max(sizes) < 4000 / 8
    # The left rows are shuffled once, with the versions; edges and carried values are single rows.
    assert plan(out).count("Exchange hashpartitioning(_group#") == 1 and "Join" not in plan(out)


def test_asof_join_of_nothing(spark, rows):
    left, right = spark.createDataFrame([(1, D(2024, 1, 1))], "id int, day date"), spark.createDataFrame([], "end date, version string")
    assert rows(joins.asof_join(left, right, "day", "end", "version")) == [(1, D(2024, 1, 1), None)]
    assert rows(joins.asof_join(left.limit(0), right, "day", "end", "version")) == []


def test_slices_follow_the_values(spark):
    df = spark.createDataFrame([(None if i % 50 == 0 else i * i,) for i in range(1, 1000)], "v int")
    for n in (2, 10, 33, 500):
        at = Slices(df, "v", n)
        out = [tuple(r) for r in at.on(df).select("v", at.below("v"), at.up_to("v"), at.dealt("v", F.xxhash64("v"))).orderBy("v").collect()]
        known = [r for r in out if r[0] is not None]
        assert all(r[1:] == (0, 0, 0) for r in out if r[0] is None)
        assert all(a[2] <= b[1] and a[1] <= a[3] <= a[2] for a, b in zip(known, known[1:])) and max(r[2] for r in known) <= n - 1
        assert len({r[1] for r in known}) >= min(n, 400) * 0.9


def test_spine_fills_missing_days(spark, rows):
    daily = spark.createDataFrame([(D(2024, 1, 2), 5)], "day date, n int")
    spine = joins.day_spine(spark, F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 3)))
    assert rows(joins.spine_join(spine, daily, "day")) == [(D(2024, 1, 1), 0), (D(2024, 1, 2), 5), (D(2024, 1, 3), 0)]


def test_reconcile_inner_and_full(spark, rows):
    a = spark.createDataFrame([(1, 10), (2, 20)], "m int, n int")
    b = spark.createDataFrame([(2, 15), (3, 30)], "m int, n int")
    assert rows(joins.reconcile(a, b, ["m"], ["n"])) == [(2, 20, 15, 5)]
    assert rows(joins.reconcile(a, b, ["m"], ["n"], how="full")) == [(1, 10, 0, 10), (2, 20, 15, 5), (3, 0, 30, -30)]


def test_presence_matrix_counts_copies(spark, rows):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("x",), ("z",)], "k string")
    assert rows(joins.presence_matrix({"a": a, "b": b}, "k")) == [("x", True, True, 2, 1), ("y", True, False, 1, 0), ("z", False, True, 0, 1)]


def test_missing_from_ignores_nulls_in_the_list(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (None,)], "j int")
    assert rows(joins.missing_from(a, (b, "k", "j"))) == [(None,), (1,)]


def test_rule_agreement_is_one_row_per_key(spark, rows):
    a = spark.createDataFrame([("t1", "c1"), ("t1", "c2"), ("t2", "c1"), ("t3", None), ("t4", "c4")], "t string, c string")
    b = spark.createDataFrame([("t1", "c2"), ("t1", "c9"), ("t2", "c3"), ("t3", "c3"), ("t4", None)], "t string, c string")
    assert rows(joins.rule_agreement(a, b, "t", "c"), "t", "agrees") == [("t1", True), ("t2", False), ("t3", False)]


def test_upsert_keys_are_the_union_and_newest_wins(spark, rows):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (None, "n", 1)], "k int, v string, t int")
    inc = spark.createDataFrame([(2, "old", 2), (2, "new", 3), (3, "c", 1)], "k int, v string, t int")
    out = merge.upsert(cur, inc, ["k"], ["t"])
    assert rows(out, "k", "v") == [(None, "n"), (1, "a"), (2, "new"), (3, "c")]
    assert rows(merge.upsert(out, inc, ["k"], ["t"])) == rows(out)


@pytest.fixture
def versions(spark):
    return spark.createDataFrame(
        [(1, "a", None, T(2024, 1, 1), None, True), (2, "b", 5, T(2024, 1, 1), None, True), (2, "x", 5, T(2023, 1, 1), T(2024, 1, 1), False), (9, "gone", 1, T(2024, 1, 1), None, True)],
        "k int, name string, size int, valid_from timestamp, valid_to timestamp, is_current boolean")


def test_scd2(spark, versions, rows):
    inc = spark.createDataFrame([(1, "a", None), (2, "b2", 5), (3, "c", 1)], "k int, name string, size int")
    at = T(2024, 6, 1)
    out = merge.scd2_merge(versions, inc, ["k"], ["name", "size"], at)
    assert rows(out, "k", "name", "valid_to", "is_current") == [
        (1, "a", None, True), (2, "b", at, False), (2, "b2", None, True), (2, "x", T(2024, 1, 1), False), (3, "c", None, True), (9, "gone", None, True)]
    assert rows(merge.scd2_merge(out, inc, ["k"], ["name", "size"], T(2024, 7, 1))) == rows(out)
    current = [r[0] for r in rows(out.filter("is_current"), "k")]
    assert len(current) == len(set(current))


def test_facts_follow_replaced_versions(spark, versions, rows):
    keyed = versions.withColumn("sk", F.col("k").cast("long") * 10 + F.col("is_current").cast("int"))
    deliver = lambda rows_: spark.createDataFrame(rows_, "k int, name string, size int")
    first = merge.scd2_merge(keyed, deliver([(1, "a", None), (2, "b2", 5)]), ["k"], ["name", "size"], T(2024, 6, 1), surrogate="sk", tenant="t")
    second = merge.scd2_merge(first, deliver([(1, "a", 7), (2, "b3", 5), (3, "c", 1)]), ["k"], ["name", "size"], T(2024, 7, 1), surrogate="sk", tenant="t")
    assert second.select("sk").distinct().count() == second.count() == 8
    facts = spark.createDataFrame([(i, [11, 20, 21, 91, 555, None][i % 6]) for i in range(60)], "id int, product long")
    now = {r["k"]: r["sk"] for r in second.filter("is_current").collect()}
    moved = merge.repoint(facts, second, ["k"], "sk", "product", T(2024, 6, 1))
    assert rows(moved) == sorted((i, [now[1], 20, now[2], 91, 555, None][i % 6]) for i in range(60))
    # Key 2 was replaced on both days: in one step or in two, its facts end at the same version.
    step = merge.repoint(merge.repoint(facts, first, ["k"], "sk", "product", T(2024, 6, 1)), second, ["k"], "sk", "product", T(2024, 7, 1))
    assert rows(step) == rows(moved)
    assert rows(merge.repoint(facts, second, ["k"], "sk", "product", T(2025, 1, 1))) == rows(facts)


def test_frame_diff_keeps_repeats_and_equates_nulls(spark, rows):
    cur = spark.createDataFrame([(1, None), (2, "b")], "k int, v string")
    inc = spark.createDataFrame([(1, None), (2, "c"), (2, "c")], "k int, v string")
    assert rows(merge.frame_diff(inc, cur, ["k", "v"])) == [(2, "c"), (2, "c")]


def test_anti_and_semi_make_the_whole(skewed, spark):
    _, df = skewed
    known = spark.createDataFrame([("hot",), ("k1",), (None,)], "key string")
    assert merge.new_keys(df, known, "key").count() + merge.keep_known(df, known, "key").count() == df.count()


def test_audit_lists_each_changed_value(spark, rows):
    before = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", 3)], "k int, n string, v int")
    after = spark.createDataFrame([(1, "b", 1), (2, "x", 5), (3, "c", 3)], "k int, n string, v int")
    log = merge.audit_changes(before, after, "k", ["n", "v"], "cleaning", T(2024, 1, 1, 22))
    assert rows(log, "k", "column_name", "previous_value", "current_value") == [(1, "n", "a", "b"), (2, "n", None, "x"), (2, "v", "2", "5")]
    assert log.first().updated_at == T(2024, 1, 2, 1)


def test_reversed_transactions_leave_both_sides(spark, rows):
    cur = spark.createDataFrame([("t1", 5.0, None, None, False), ("t2", 6.0, None, None, False)], "transaction_id string, amount double, is_repayment boolean, receipt string, is_reversed boolean")
    inc = spark.createDataFrame([("t1", 5.5, 2, " ", 0), ("t3", 7.0, 1, "r3", 0), ("t4", 8.0, 9, "", 0)], "transaction_id string, amount double, transaction_type int, receipt string, is_reversed int")
    gone = spark.createDataFrame([("t2",), ("t3",)], "transaction_id string")
    out = extract.load_transactions(cur, inc, gone, ["receipt"], ["transaction_id"], ["amount"])
    assert rows(out, "transaction_id", "amount", "is_repayment", "receipt") == [("t1", 5.5, True, None), ("t4", 8.0, None, None)]


def test_model_version_is_strictly_before_and_known_wins(spark, rows):
    loans = spark.createDataFrame([(1, D(2024, 1, 10)), (2, D(2024, 1, 11)), (3, D(2023, 1, 1)), (4, D(2024, 5, 1))], "loan_id int, disbursed_on date")
    known = spark.createDataFrame([(4, "kept")], "loan_id int, model_version string")
    ends = spark.createDataFrame([("v1", D(2024, 1, 10)), ("v0", D(2024, 1, 1))], "model_version string, end_date date")
    assert rows(extract.with_model_version(loans, known, ends), "loan_id", "model_version") == [(1, "v0"), (2, "v1"), (3, None), (4, "kept")]


def test_suspension_changes(spark, rows):
    events = spark.createDataFrame([(1, D(2024, 2, 1), None, True), (2, D(2024, 2, 1), None, True), (3, None, D(2024, 2, 1), False)], "shop int, start_date date, end_date date, is_suspended boolean")
    stored = spark.createDataFrame([(1, True, D(2024, 1, 1), None), (2, True, D(2024, 3, 1), None), (3, True, D(2024, 1, 1), None)], "shop int, is_suspended boolean, start_date date, end_date date")
    assert rows(extract.suspension_changes(events, stored), "shop") == [(2,), (3,)]


def test_answers_take_the_first_and_leave_blanks(spark, rows):
    df = spark.createDataFrame([("o1", 1, "x", 2), ("o1", 1, "first", 1), ("o1", 2, None, 1), ("o2", 9, "skip", 1)], "outlet string, q int, a string, seq int")
    out = extract.answers_to_columns(df, "outlet", "q", "a", "seq", {1: "name", 2: "phone"})
    assert rows(out) == [("o1", "first", None)]


def test_child_rows_of_blank_and_empty_lists(spark, rows):
    df = spark.createDataFrame([(1, '[{"id": "a"}, {"id": "b"}]'), (2, "  "), (3, "[]"), (4, None)], "k int, items string")
    assert rows(extract.child_rows(df, "k", "items", "id: string", ["id"])) == [(1, "a"), (1, "b")]


def test_collections_need_every_parent(spark, rows):
    notes = spark.createDataFrame([(1, 10, 5), (2, 11, 5), (3, 10, 6), (3, 10, 6)], "id int, case_id int, user_id int")
    cases, users = spark.createDataFrame([(10,)], "case_id int"), spark.createDataFrame([(5,), (6,)], "uid int")
    stored = spark.createDataFrame([(1,)], "id int")
    assert rows(extract.collections_entity(notes, stored, "id", [(cases, "case_id", "case_id"), (users, "user_id", "uid")])) == [(3, 10, 6)]


def test_failures_made_good_do_not_count(spark, rows):
    df = spark.createDataFrame(
        [("r1", 400, "late", "repayment"), ("r1", 200, None, "repayment"), ("r2", 400, "late", "repayment"), ("r3", 200, None, "disbursement")],
        "receipt string, status int, reason string, kind string").withColumn("day", F.lit(D(2024, 1, 1)))
    out = aggregate.failure_breakdown(df, "day", "kind", "status", "reason", "receipt")
    assert rows(out, "successful_repayments", "successful_disbursements", "failure_reason", "failed") == [(1, 1, "late", 1)]


def test_period_then_mean_and_conflicts(spark, rows):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 10.0), ("a", D(2024, 1, 9), 20.0), ("a", D(2024, 2, 1), 50.0)], "k string, day date, v double")
    assert rows(aggregate.period_then_mean(df, "k", F.trunc("day", "MM"), "v", "mean")) == [("a", 40.0)]
    assert rows(aggregate.conflicting_keys(df, ["k"], "v")) == [("a", 3)]


def test_till_activity_takes_one_recent_day(spark, rows):
    df = spark.createDataFrame([(1, T(2024, 1, 12, 0), "1,000.5"), (2, T(2024, 1, 12, 23, 59), "x"), (3, T(2024, 1, 13), "5")], "id int, transaction_time timestamp_ntz, balance string")
    assert rows(ingest.till_activity(df, "2024-01-12", "2024-02-01"), "id", "balance") == [(1, 1000.5), (2, None)]
    assert ingest.till_activity(df, "2024-01-12", "2024-06-01").count() == 0


def test_surrogate_keys_repeat(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1))], "k int, valid_from timestamp")
    key = lambda: df.select(merge.surrogate_key(F.lit("t"), ["k"])).first()[0]
    assert key() == key()


def test_distinct_counts_without_expand(spark, rows, plan):
    random.seed(4)
    data = [(random.choice(["hot"] * 9 + ["a", "b", None]), random.choice([None, -5, 0, 1, 32767, 32768, 32769, 10**12, 7]), i % 977, None) for i in range(5000)]
    df = spark.createDataFrame(data + [("only nulls", None, None, None)], "k string, a long, b int, c long")
    out = aggregate.distinct_counts(df, ["k"], {"n_a": "a", "n_b": "b", "n_c": "c"})
    assert rows(out, "k", "n_a", "n_b", "n_c") == rows(df.groupBy("k").agg(F.countDistinct("a"), F.countDistinct("b"), F.countDistinct("c")))
    assert "Expand" not in plan(out) and aggregate.distinct_counts(df.limit(0), ["k"], {"n": "a"}).count() == 0
