"""Agent, salary and bureau scoring."""
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import AS_OF, CTE, EVENTS_AS_OF, activity, clients, loans, money, query, repayments, table
from ledgerloom.plans import agent_scoring as agents, bureau_rules, limits as publishing, salary_scoring as salary

CTE.update({
    "commission": """select agent_id, cast(sum(credit) as double) as total_commissions_amount,
        count(distinct cast(ts as date)) as unique_number_of_commissions, count(distinct narration) as unique_number_of_services_offered,
        count(distinct date_trunc('month', ts)) as number_of_months_received_commissions from activity
        where cast(ts as date) > date '2023-07-31' and biller = 'Agent Commission' and status = 'Approved' group by agent_id""",
    "debits": "select *, cast(ts as date) as day from activity where cast(ts as date) >= date '2023-07-31' and debit > 0 and status = 'Approved'",
    "summary": """select g.*, coalesce(n.lowest, 0) as lowest_negative_balance, coalesce(n.highest, 0) as highest_negative_balance,
        coalesce(n.days, 0) as unique_negative_balance_dates, coalesce(n.first, latest_transaction_date) as earliest_negative_balance_date,
        coalesce(n.last, latest_transaction_date) as latest_negative_balance_date,
        cast(latest_transaction_date - coalesce(n.last, latest_transaction_date) as bigint) as days_since_latest_negative_balance from (
          select agent_id, cast(sum(debit) as double) as total_debit_amount, cast(sum(debit) as double) / count(*) as average_transaction_size,
            count(distinct request_ref) as total_transactions, min(day) as earliest_transaction_date, max(day) as latest_transaction_date,
            count(distinct biller) as no_of_services_offered, cast(min(balance) as double) as min_balance, cast(max(balance) as double) as max_balance,
            cast(sum(balance) as double) / count(*) as average_balance, cast(min(debit) as double) as min_debit_amt,
            cast(max(debit) as double) as max_debit_amt, count(distinct day) as unique_transaction_days,
            count(distinct date_trunc('month', day)) as unique_transaction_months, cast(185 as double) as expected_transaction_days,
            round_even(count(distinct day) / cast(185 as double) * 100, 0) / 100 as daily_trading_consistency,
            round_even(count(distinct request_ref) / count(distinct day), 0) as average_daily_transactions,
            round_even(cast(sum(debit) as double) / 185, 0) as average_daily_debit_amt,
            cast(date '2024-01-31' - max(day) as bigint) as days_since_last_transaction
          from debits where balance >= 0 group by agent_id) g
        left join (select agent_id, cast(min(balance) as double) as lowest, cast(max(balance) as double) as highest, count(distinct day) as days,
          min(day) as first, max(day) as last from debits where balance < 0 group by agent_id) n using (agent_id)""",
    "scored": """select *, coalesce(trading_consistency_score, 0) + coalesce(age_on_network_score, 0) + coalesce(recency_in_months_score, 0)
          + coalesce(average_daily_debit_score, 0) + coalesce(unique_number_of_commissions_score, 0) as total_score from (
        select s.*, c.* exclude (agent_id), cast(ceil((latest_transaction_date - earliest_transaction_date) / 30.436875::double + 1) as bigint) as evaluation_months,
          case when daily_trading_consistency < 0.3 then -100 when daily_trading_consistency < 0.5 then 0 when daily_trading_consistency < 0.6 then 50
            when daily_trading_consistency < 0.75 then 100 when daily_trading_consistency < 0.9 then 150 when daily_trading_consistency <= 1 then 200 end as trading_consistency_score,
          case when ceil((latest_transaction_date - earliest_transaction_date) / 30.436875::double + 1) <= 1 then -100
            when ceil((latest_transaction_date - earliest_transaction_date) / 30.436875::double + 1) <= 3 then 0 else 50 end as age_on_network_score,
          200 as recency_in_months_score,
          case when average_daily_debit_amt < 20000 then -100 when average_daily_debit_amt < 35000 then 0 when average_daily_debit_amt < 50000 then 25
            when average_daily_debit_amt < 100000 then 35 when average_daily_debit_amt < 200000 then 50 when average_daily_debit_amt < 500000 then 75
            when average_daily_debit_amt < 750000 then 100 when average_daily_debit_amt < 1000000 then 150 else 200 end as average_daily_debit_score,
          case when unique_number_of_commissions < 2 then -100 when unique_number_of_commissions < 3 then 0 when unique_number_of_commissions < 5 then 100
            when unique_number_of_commissions < 6 then 150 else 200 end as unique_number_of_commissions_score
        from summary s join commission c using (agent_id))""",
    "history": """select c.client_id as agent_id, c.client_id, c.n as count_of_loans, (date '2024-01-31' - c.last_on) / 30.436875::double as months_since_last_disbursement,
        cast(c.p as double) as total_principal, cast(r.paid as double) as repayments_in_time,
        cast(r.paid as double) / cast(c.p as double) * 100 as percentage_repayment_in_time
        from (select client_id, count(*) as n, max(disbursed_on) as last_on, sum(principal) as p from loans group by 1) c
        left join (select client_id, sum(amount) as paid from loans join repayments using (loan_id) where paid_on < matures_on + 9 group by 1) r using (client_id)""",
    "limited": """select *, case when c.count_of_loans = 0 and capped > 0 then greatest(capped * 0.5::double, 35000) else capped end as current_limit from (
        select *, case when rounded_limit < 35000 then 0 when rounded_limit > 1000000 then 1000000 else rounded_limit end as capped from (
        select *, cast(ceil(minimum_limit / 100::double) * 100 as double) as rounded_limit from (
        select *, average_daily_debit_amt * 30 * limit_factor as minimum_limit from (
        select *, case when loan_band = 'Band 1' then 0.119 when loan_band = 'Band 2' then case repayment_band when 'Band 4' then 0.083 when 'Band 5' then 0.108 when 'Band 6' then 0.128 else 0 end
          when loan_band = 'Band 3' then case repayment_band when 'Band 4' then 0.098 when 'Band 5' then 0.123 when 'Band 6' then 0.136 else 0 end
          when loan_band = 'Band 4' then case repayment_band when 'Band 4' then 0.113 when 'Band 5' then 0.138 when 'Band 6' then 0.145 else 0 end
          when loan_band = 'Band 5' then case repayment_band when 'Band 4' then 0.128 when 'Band 5' then 0.153 when 'Band 6' then 0.17 else 0 end else 0 end::double as limit_factor from (
        select s.*, coalesce(h.count_of_loans, 0) as count_of_loans, h.months_since_last_disbursement, h.percentage_repayment_in_time,
          case when coalesce(h.count_of_loans, 0) = 0 then 'Band 1' when h.count_of_loans <= 2 then 'Band 2' when h.count_of_loans <= 5 then 'Band 3'
            when h.count_of_loans <= 9 then 'Band 4' else 'Band 5' end as loan_band,
          case when p < 0 then null when p < 30 then 'Band 1' when p < 50 then 'Band 2' when p < 70 then 'Band 3' when p < 90 then 'Band 4' when p < 100 then 'Band 5' when p >= 100 then 'Band 6' end as repayment_band
        from (select * from scored where agent_id in (select client_id from clients)) s
        left join (select *, percentage_repayment_in_time as p from history) h using (agent_id)))))) c""",
    "results": """select client_id as agent_id, 'm7[2022-11-05, ' || (disbursed_on + 8217) || ']' as model_version, disbursed_on + 8217 as version_day,
        case when client_id % 5 = 0 then loan_id else cast(disbursed_on - date '1970-01-01' as bigint) * 100000000 + loan_id end as result_id,
        cast(ceil(principal / 100) * 100 as double) as amount from loans""",
    "earlier": """select agent_id, previous_m_limit, previous_2m_limit from (
        select agent_id, case when m.result_id = mid then m.amount end as previous_m_limit, case when m2.result_id = m2id then m2.amount end as previous_2m_limit from (
        select agent_id, max({'v': model_version, 'result_id': result_id, 'amount': amount}) filter (where version_day < date '2023-12-31') as m, max(result_id) filter (where version_day < date '2023-12-31') as mid,
          max({'v': model_version, 'result_id': result_id, 'amount': amount}) filter (where version_day < date '2023-11-30') as m2, max(result_id) filter (where version_day < date '2023-11-30') as m2id
        from results group by agent_id)) where previous_m_limit is not null""",
    "latest_result": "select agent_id, max({'v': model_version, 'i': result_id, 'amount': amount}).amount as previous_limit from results group by agent_id",
    "stable": """select *, case when held = 0 then held when previous_limit > previous_2m_limit then previous_limit
          when previous_limit < previous_2m_limit and held > previous_limit then previous_limit else held end as final_limit from (
        select *, case when current_limit = 0 or previous_limit = 0 then current_limit when current_limit >= previous_limit * 1.5::double then previous_limit * 1.5::double
          when current_limit >= previous_limit * 0.85::double and current_limit <= previous_limit * 1.15::double then previous_limit else current_limit end as held from (
        select l.*, coalesce(r.previous_limit, 0) as previous_limit, coalesce(e.previous_m_limit, 0) as previous_m_limit, coalesce(e.previous_2m_limit, 0) as previous_2m_limit
        from limited l left join latest_result r using (agent_id) left join earlier e using (agent_id)))""",
})
_BASE = ("activity", "commission", "debits", "summary")
_SCORED = (*_BASE, "scored")
_FULL = (*_SCORED, "clients", "loans", "repayments", "history", "limited", "results", "earlier", "latest_result", "stable")


def _results(spark, d):
    """Stored scoring results: one row per loan, with the run's model version."""
    day = F.date_add("disbursed_on", 8217)
    rid = F.datediff("disbursed_on", F.lit("1970-01-01").cast("date")).cast("long") * 100000000 + F.col("loan_id")
    return loans(spark, d).select(
        F.col("client_id").alias("agent_id"), F.concat(F.lit("m7[2022-11-05, "), day.cast("string"), F.lit("]")).alias("model_version"),
        F.when(F.col("client_id") % 5 == 0, F.col("loan_id")).otherwise(rid).alias("result_id"),
        (F.ceil(F.col("principal") / 100) * 100).cast("double").alias("limit"))


def _agents(spark, d):
    return clients(spark, d).select(F.col("client_id").alias("agent_id"), "client_id")


@query("commission_summary", "select * from commission", ("activity", "commission"))
def commission_summary(spark, d):
    return agents.commission_summary(activity(spark, d), EVENTS_AS_OF)


@query("agent_activity_summary", "select * from summary", ("activity", "debits", "summary"))
def agent_activity_summary(spark, d):
    out = agents.activity_summary(activity(spark, d), EVENTS_AS_OF)
    return out.withColumns({c: F.col(c).cast("long") for c in ("days_since_last_transaction", "days_since_latest_negative_balance")})


_SCORE_COLUMNS = ["agent_id", "evaluation_months", "trading_consistency_score", "age_on_network_score", "recency_in_months_score",
                  "average_daily_debit_score", "unique_number_of_commissions_score", "total_score"]


def _scored(spark, d):
    rows = activity(spark, d)
    return agents.scores(agents.commission_summary(rows, EVENTS_AS_OF).join(agents.activity_summary(rows, EVENTS_AS_OF), "agent_id"))


@query("agent_scores", f"select {', '.join(f'cast({c} as bigint) as {c}' for c in _SCORE_COLUMNS)} from scored", _SCORED)
def agent_scores(spark, d):
    return _scored(spark, d).select([F.col(c).cast("long").alias(c) for c in _SCORE_COLUMNS])


@query("hurdle_rate", "select * from history", ("loans", "repayments", "history"))
def hurdle_rate(spark, d):
    used = loans(spark, d).select("client_id").distinct().join(_agents(spark, d).select("client_id"), "client_id", "left")
    return agents.loan_history(used.select(F.col("client_id").alias("agent_id"), "client_id"), loans(spark, d), repayments(spark, d), EVENTS_AS_OF)


@query("limit_matrix", """
select agent_id, count_of_loans, loan_band, repayment_band, limit_factor, minimum_limit, rounded_limit, current_limit from limited""", _FULL[:-4])
def limit_matrix(spark, d):
    known = _scored(spark, d).join(_agents(spark, d).select("agent_id"), "agent_id", "left_semi")
    out = agents.limits(known, agents.loan_history(_agents(spark, d), loans(spark, d), repayments(spark, d), EVENTS_AS_OF))
    return out.select("agent_id", "count_of_loans", "loan_band", "repayment_band", "limit_factor", "minimum_limit", "rounded_limit", "current_limit")


@query("limits_before", "select * from earlier", ("loans", "results", "earlier"))
def limits_before(spark, d):
    return agents.earlier_limits(_results(spark, d), EVENTS_AS_OF).filter("previous_m_limit is not null").drop("previous_limit")


@query("agent_limits", """
select *, case rules_summary when 'All rules passed. ' then ' Limits assigned per lending criteria ' when 'Limit below product min ' then ' Limits assigned less than product thresholds'
  when 'Inconsistent Repayments. ' then ' You have been inconsistent in paying your loans on time - please consistently pay your loans on time'
  else ' Based on historical and current information on your business and loan history, you do not currently meet our lending criteria' end as communication,
  case rules_summary when 'All rules passed. ' then ' F001' when 'Limit below product min ' then ' D001' when 'Inconsistent Repayments. ' then ' A001' else ' C004' end as reason_code
from (select agent_id, cast(total_score as bigint) as total_score, current_limit, previous_limit, previous_m_limit, previous_2m_limit, held as limit_after_stabilisation, final_limit,
  final_limit > 0 and total_score >= 600 as is_qualified, case when final_limit > 0 and total_score >= 600 then case when limit_factor = 0 then 'Inconsistent Repayments. ' else 'All rules passed. ' end
  when trading_consistency_score <= 0 then 'Trading consistency is below set threshold and total score is < 600. '
  when average_daily_debit_score <= 0 then 'Average daily debit amount is below set threshold and total score is < 600. '
  when total_score < 600 then 'Total score is below 600. ' when age_on_network_score <= 0 then 'Age on network is below set threshold and total score is < 600. '
  when recency_in_months_score <= 0 then 'Number of months with no activity is below set threshold and total score is < 600. '
  when unique_number_of_commissions_score <= 0 then 'Number of commission payments is below set threshold and total score is < 600. '
  when limit_factor = 0 then 'Inconsistent Repayments. ' else 'Limit below product min ' end as rules_summary from stable)""", _FULL)
def agent_limits(spark, d):
    """The whole scoring run: activity, loans and history to published limits."""
    out = agents.score_agents(activity(spark, d), _agents(spark, d), loans(spark, d), repayments(spark, d), _results(spark, d), EVENTS_AS_OF)
    return out.select("agent_id", F.col("total_score").cast("long").alias("total_score"), "current_limit", "previous_limit", "previous_m_limit",
                      "previous_2m_limit", "limit_after_stabilisation", "final_limit", "is_qualified", "rules_summary", "communication", "reason_code")


@query("graduation", """
select agent_id, case when current_limit <> 0 and months_since_last_disbursement <= 280 and count_of_loans > 1 and previous_limit > 0 then previous_limit else current_limit end as graduated
from stable""", _FULL)
def graduation(spark, d):
    """Months are counted against the old loans of the test data."""
    out = agents.score_agents(activity(spark, d), _agents(spark, d), loans(spark, d), repayments(spark, d), _results(spark, d), EVENTS_AS_OF)
    months = F.when(F.col("months_since_last_disbursement") <= 280, 0).otherwise(2)
    return out.select("agent_id", agents.graduate(F.col("current_limit"), F.col("previous_limit"), F.col("count_of_loans"), months).alias("graduated"))


# Salaries: one payment per delivered line.
SALARY_END = "2001-11-30"
CTE.update({
    "salaries": """select l_partkey as client_id, l_shipdate as paid_at, cast(l_extendedprice as decimal(18,2)) as amount, l_suppkey as account,
        l_linenumber as bank, l_shipdate + to_days(l_linenumber) as created_at, l_partkey % 5 = 0 as gov, l_partkey % 5 in (1, 2) as mnc from lineitem""",
    "salary_days": """select client_id, cast(paid_at as date) as day, arg_max(amount, {'c': created_at, 'a': amount}) as one, sum(amount) as every, bool_and(gov) as g, bool_or(mnc) as m
        from (select distinct * from salaries where paid_at >= case when gov then date '2001-02-01' else date '2001-05-01' end) group by 1, 2""",
    "salary_months": """select *, max(month) over (partition by client_id) as last_month, month >= date '2001-06-01' as in6,
          case when g then month >= date '2001-03-01' else month >= date '2001-06-01' end as in_long from (
        select client_id, cast(date_trunc('month', day) as date) as month, sum(one) as one, sum(every) as every, count(*) as n, min(one) as least, min(day) as first_day,
          max(day) as last_day, bool_and(g) as g, bool_or(m) as m from salary_days group by 1, 2)""",
    "salary_summary": """select *, count_of_payments_long >= 6 or (not is_government and count_of_payments_long > 0 and sum_of_payments_long >= average_monthly_long * 6) as is_qualified_on_salaries,
          count_of_payments_3m >= 2 as payday_is_qualified_on_salaries from (
        select client_id, bool_or(g) as is_government, bool_or(m) as is_multinational, coalesce(sum(n) filter (where in_long), 0) as count_of_payments_long,
          cast(coalesce(sum(one) filter (where in_long), 0) as double) as sum_of_payments_long, cast(coalesce(min(least) filter (where in_long), 0) as double) as minimum_payment_long,
          min(first_day) filter (where in_long) as earliest_payment_long, max(last_day) filter (where in_long) as latest_payment_long,
          cast(coalesce(arg_max(one, month) filter (where in_long), 0) as double) as latest_amount_long,
          coalesce(cast(sum(one) filter (where in_long) as double) / count(*) filter (where in_long), 0) as average_monthly_long,
          sum(n) filter (where in3) as count_of_payments_3m, cast(sum(one) filter (where in3) as double) as sum_of_payments_3m, cast(min(least) filter (where in3) as double) as minimum_payment_3m,
          min(first_day) filter (where in3) as earliest_payment_3m, max(last_day) filter (where in3) as latest_payment_3m, cast(arg_max(one, month) filter (where in3) as double) as latest_amount_3m,
          cast(sum(one) filter (where in3) as double) / count(*) filter (where in3) as average_monthly_3m,
          coalesce(case when bool_or(g) then cast(sum(every) filter (where in6) as double) / nullif(count(*) filter (where in6), 0) else cast(sum(one) filter (where in_long) as double) / nullif(count(*) filter (where in_long), 0) end, 0) as average_monthly_6m,
          cast(case when bool_or(g) then 9 else 6 end as bigint) as months_in_period
        from (select *, month >= last_month - interval 2 month as in3 from salary_months) group by client_id)""",
    "debt": """select client_id, cast(sum(repayment) as double) as total_debt_value, count(*) filter (where running) as count_of_running_loans from (
        select client_id, disbursed_on, sum(principal * 0.01) as repayment, bool_or(loan_status <> 600) as running from loans group by 1, 2) group by 1""",
    "salary_limits": """select *, base and limit_3m > 0 as is_3m_qualified, base and limit_6m > 0 as is_6m_qualified,
          (is_government or is_multinational) and payday_is_qualified_on_salaries and payday_debt_share <= 0.5 and payday_latest_covers_minimum and count_of_running_loans <= 5 and limit_1m > 0 as is_1m_qualified from (
        select *, is_qualified_on_salaries and debt_share <= 0.5 and latest_covers_minimum and count_of_running_loans <= 5 as base,
          case when r6 < 30000 then 0 when r6 > 1000000 then 1000000 else r6 end as limit_6m, case when r3 < 30000 then 0 when r3 > 1000000 then 1000000 else r3 end as limit_3m,
          case when r1 < 15000 then 0 when r1 > 250000 then 250000 else r1 end as limit_1m from (
        select *, cast(ceil(1.0::double * average_monthly_long * (1 - debt_share) / 100::double) * 100 as double) as r6, cast(ceil(0.5::double * average_monthly_long * (1 - debt_share) / 100::double) * 100 as double) as r3,
          case when is_government or is_multinational then cast(ceil(0.2::double * average_monthly_3m * (1 - payday_debt_share) / 100::double) * 100 as double) else 0 end as r1,
          latest_amount_long >= minimum_payment_long as latest_covers_minimum, latest_amount_3m >= minimum_payment_3m or latest_amount_3m >= average_monthly_3m as payday_latest_covers_minimum from (
        select s.*, coalesce(total_debt_value, 0) as total_debt_value, coalesce(count_of_running_loans, 0) as count_of_running_loans,
          coalesce(round_even(coalesce(total_debt_value, 0) / nullif(average_monthly_long, 0) * 10, 0) / 10, 1) as debt_share,
          coalesce(round_even(coalesce(total_debt_value, 0) / nullif(average_monthly_3m, 0) * 10, 0) / 10, 1) as payday_debt_share
        from salary_summary s left join debt using (client_id))))""",
})
_SALARY = ("salaries", "salary_days", "salary_months", "salary_summary")


def _salaries(spark, d):
    line = table(spark, d, "lineitem")
    rows = line.select(
        F.col("l_partkey").alias("client_id"), F.col("l_shipdate").alias("paid_at"), money("l_extendedprice").alias("amount"),
        F.col("l_suppkey").alias("account"), F.col("l_linenumber").alias("bank"),
        (F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber"))).alias("created_at"),
        F.concat(F.lit("Company "), (F.col("l_partkey") % 5).cast("string")).alias("company"))
    names = table(spark, d, "region").select(F.col("r_regionkey"), F.concat(F.lit("Company "), F.col("r_regionkey").cast("string")).alias("company"))
    return salary.employer_flags(rows, names.filter("r_regionkey = 0"), names.filter("r_regionkey in (1, 2)"))


def _debts(spark, d):
    return loans(spark, d).select(
        "client_id", F.col("channel").alias("lender"), F.col("disbursed_on").cast("timestamp_ntz").alias("disbursed_at"), F.col("loan_id").cast("string").alias("status"),
        F.col("principal").alias("loan_amount"), F.when(F.col("loan_status") == 600, 0).otherwise(F.col("principal")).alias("outstanding"),
        (F.col("principal") * F.lit("0.01").cast("decimal(3,2)")).alias("repayment"), F.col("matures_on").alias("created_at"))


@query("salary_summary", "select * from salary_summary", _SALARY)
def salary_summary(spark, d):
    out = salary.salary_summary(_salaries(spark, d), SALARY_END)
    return out.withColumn("months_in_period", F.col("months_in_period").cast("long"))


@query("salary_defaults", """
select c.client_id, coalesce(count_of_payments_long, 0) as count_of_payments_long, coalesce(average_monthly_long, 0) as average_monthly_long,
  case when s.client_id is null then date '2001-11-30' else coalesce(latest_payment_long, date '2001-11-30') end as latest_payment_long, coalesce(is_government, false) as is_government, coalesce(months_in_period, 6) as months_in_period
from clients c left join salary_summary s using (client_id)""", ("clients", *_SALARY))
def salary_defaults(spark, d):
    out = salary.with_defaults(clients(spark, d), salary.salary_summary(_salaries(spark, d), SALARY_END), SALARY_END)
    return out.select("client_id", "count_of_payments_long", "average_monthly_long", "latest_payment_long", "is_government",
                      F.col("months_in_period").cast("long").alias("months_in_period"))


_LIMIT_COLUMNS = ["client_id", "total_debt_value", "count_of_running_loans", "debt_share", "payday_debt_share", "limit_6m", "limit_3m", "limit_1m",
                  "latest_covers_minimum", "payday_latest_covers_minimum", "is_3m_qualified", "is_6m_qualified", "is_1m_qualified"]


def _salary_limits(spark, d):
    return salary.debt_and_limits(salary.salary_summary(_salaries(spark, d), SALARY_END), _debts(spark, d))


@query("salary_limits", f"select {', '.join(_LIMIT_COLUMNS)} from salary_limits", (*_SALARY, "loans", "debt", "salary_limits"))
def salary_limits(spark, d):
    return _salary_limits(spark, d).select(_LIMIT_COLUMNS)


@query("client_eligibility", """
with l as (select client_id, max(paid_at) as last_at, bool_or(gov) as gov, bool_or(mnc) as mnc from salaries group by 1)
select c.client_id, coalesce(last_at > timestamp '2001-02-28', false) as last_salary_within_9_months, coalesce(last_at > timestamp '2001-05-30', false) as last_salary_within_6_months,
  coalesce(gov, false) as is_government, coalesce(mnc, false) as is_multinational from clients c left join l using (client_id)""", ("clients", "salaries"))
def client_eligibility(spark, d):
    return salary.eligibility(clients(spark, d), _salaries(spark, d), SALARY_END)


CTE["tenor"] = """select loan_id, client_id, case when loan_id % 3 = 0 then 19 else 18 end as product_id, disbursed_on, matures_on,
    case when loan_status <> 300 then disbursed_on + 40 end as closed_on, loan_status from loans"""
CTE["tenure"] = """select c.client_id, coalesce(h.n >= 2 and h.first_product = 19, false) as had_six_months,
      coalesce(t.n = 2 and c1 is not null and c2 is not null and m1 <= date '2001-08-01' and m2 <= date '2001-08-01', false) as is_complete,
      coalesce(t.n = 2 and d1 - d2 <= 45, false) as is_consecutive, coalesce(d1 + 60 <= date '2001-08-01', false) as is_recent
    from clients c left join (select client_id, count(*) as n, arg_min(product_id, loan_id) as first_product from tenor group by 1) h using (client_id)
    left join (select client_id, count(*) as n, max(disbursed_on) filter (where r = 1) as d1, max(disbursed_on) filter (where r = 2) as d2, max(closed_on) filter (where r = 1) as c1,
        max(closed_on) filter (where r = 2) as c2, max(matures_on) filter (where r = 1) as m1, max(matures_on) filter (where r = 2) as m2
      from (select *, row_number() over (partition by client_id order by disbursed_on desc, loan_id desc) as r from tenor where product_id = 18) where r <= 2 group by 1) t using (client_id)"""


def _tenor(spark, d):
    return loans(spark, d).withColumns({
        "product_id": F.when(F.col("loan_id") % 3 == 0, 19).otherwise(18),
        "closed_on": F.when(F.col("loan_status") != 300, F.date_add("disbursed_on", 40))})


@query("tenure_rules", "select *, had_six_months or (is_complete and is_consecutive and is_recent) as passes from tenure", ("clients", "loans", "tenor", "tenure"))
def tenure_rules(spark, d):
    return salary.tenure_rules(clients(spark, d), _tenor(spark, d), AS_OF)


@query("loan_counts", """
select c.client_id, count(t.loan_id) as count_of_loans from clients c left join tenor t on t.client_id = c.client_id and t.product_id = 19 and t.loan_status in (300, 600) group by 1""", ("clients", "loans", "tenor"))
def loan_counts(spark, d):
    return salary.loan_counts(clients(spark, d), _tenor(spark, d), [19], (300, 600))


# Bureau reports: one per loan, sections derived from the loan id.
CTE["features"] = """select client_id, cast(n as bigint) as total_no_of_facilities, cast(list_sum([(k * i) % 5000 for i in range(1, n + 1)]) as double) as total_overdue_amount,
    cast(list_max([(k * i) % 120 for i in range(1, n + 1)]) as bigint) as maximum_days_in_arrears, cast(case when k % 4 = k % 3 then 1 else 2 end as bigint) as no_of_institution_types,
    len([i for i in range(1, n + 1) if (k + i) % 9 < 2]) > 0 as at_deposit_bank from (
    select client_id, loan_id as k, loan_id % 7 + 1 as n from (select *, row_number() over (partition by client_id order by disbursed_on desc, doc desc) as r from (
      select *, '{"ConsumerHitResponse":{"BODY":{"ClassificationInsType":[{"AMOUNT_OVERDUE":"1,200.00","INSTITUTION_TYPE":"type ' || (loan_id % 4) || '"},{"AMOUNT_OVERDUE":"0","INSTITUTION_TYPE":"type ' || (loan_id % 3) || '"}],"ClassificationProdType":[{"AMOUNT_OVERDUE":"' || loan_id || '.00"' as doc from loans)) where r = 1)"""


def _reports(spark, d):
    k = F.col("loan_id")
    text = lambda c: c.cast("string")
    facility = lambda i: F.struct(
        F.concat_ws("-", text(k), text(i)).alias("ACCOUNT_NUMBER"), F.format_number((k * i) % 5000, 2).alias("AMOUNT_OVERDUE_CAL"),
        F.concat(F.lit("BANK "), text((k + i) % 9)).alias("INSTITUTION_NAME"), text((k * i) % 120).alias("NUM_OF_DAYS_IN_ARREARS_CAL"))
    types = F.array(
        F.struct(F.lit("1,200.00").alias("AMOUNT_OVERDUE"), F.concat(F.lit("type "), text(k % 4)).alias("INSTITUTION_TYPE")),
        F.struct(F.lit("0").alias("AMOUNT_OVERDUE"), F.concat(F.lit("type "), text(k % 3)).alias("INSTITUTION_TYPE")))
    products = F.array(F.struct(F.concat(text(k), F.lit(".00")).alias("AMOUNT_OVERDUE"), F.col("channel").alias("PRODUCT_TYPE")))
    body = F.struct(types.alias("ClassificationInsType"), products.alias("ClassificationProdType"),
                    F.transform(F.sequence(F.lit(1), (k % 7 + 1).cast("int")), facility).alias("CreditFacilityHistory24"))
    return loans(spark, d).select("client_id", F.col("disbursed_on").alias("created_at"),
                                  F.to_json(F.struct(F.struct(body.alias("BODY")).alias("ConsumerHitResponse"))).alias("report"))


BANKS = ["BANK 0", "BANK 1"]


@query("bureau_features", "select * from features", ("loans", "features"))
def bureau_features(spark, d):
    out = bureau_rules.report_features(_reports(spark, d), BANKS).drop("facilities_json")
    return out.withColumns({c: F.col(c).cast("long") for c in ("total_no_of_facilities", "maximum_days_in_arrears", "no_of_institution_types")})


@query("bureau_products", """
select client_id, channel as product_type, cast(loan_id as double) as amount_overdue from (select *, row_number() over (partition by client_id order by disbursed_on desc, doc desc) as r from (
  select *, '{"ConsumerHitResponse":{"BODY":{"ClassificationInsType":[{"AMOUNT_OVERDUE":"1,200.00","INSTITUTION_TYPE":"type ' || (loan_id % 4) || '"},{"AMOUNT_OVERDUE":"0","INSTITUTION_TYPE":"type ' || (loan_id % 3) || '"}],"ClassificationProdType":[{"AMOUNT_OVERDUE":"' || loan_id || '.00"' as doc from loans)) where r = 1""", ("loans",))
def bureau_products(spark, d):
    return bureau_rules.product_overdue(_reports(spark, d))


def _bodies(spark, d):
    """Reports with 0 to 3 facilities, a performance row for each of two institutions, a score, and details in every second one."""
    text = lambda c: c.cast("string")
    n = (F.col("loan_id") % 4).cast("int")
    facility = lambda i: F.struct(
        F.concat(text(F.col("loan_id")), F.lit("/"), text(i)).alias("ACCOUNT_NUMBER"), F.concat(text(i), F.lit(",200.50")).alias("AMOUNT_OVERDUE_CAL"),
        F.lit("lost").alias("ASSET_CLASSIFICATION_CAL"), F.lit("1,000").alias("CURRENT_BALANCE_CAL"), text(F.col("disbursed_on")).alias("DATE_REPORTED"),
        F.concat(F.lit("bank "), text(i)).alias("INSTITUTION_NAME"), F.lit("3").alias("DATE_REPORTED_AGE"), F.lit("open").alias("LOAN_STATUS"),
        F.lit("personal").alias("LOAN_TYPE_VALUE"), text(F.col("matures_on")).alias("MATURITY_DT"), text(i * 30).alias("NUM_OF_DAYS_IN_ARREARS_CAL"))
    performance = lambda name, count: F.struct(
        F.concat(text(count), F.lit(",000")).alias("FACILITIES_COUNT"), F.lit(name).alias("INSTITUTION_NAME"), F.lit("0").alias("NONPERFORMING_FACILITY"),
        F.lit("12,345.5").alias("OVERDUE_AMOUNT"), text(count).alias("PERFORMING_FACILITY"))
    body = F.struct(
        F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), facility).alias("CreditFacilityHistory24"),
        F.array(performance("first", F.col("loan_id") % 7 + 1), performance("second", F.col("loan_id") % 5 + 1)).alias("SummaryOfPerformance"),
        F.when(F.col("loan_id") % 2 == 0, F.struct(F.concat(F.lit("N"), text(F.col("loan_id"))).alias("CIR_NUMBER"), text(F.col("disbursed_on")).alias("REPORT_ORDER_DATE"))).alias("ReportDetailBVN"),
        F.struct(text(F.col("loan_id") % 850).alias("CREDIT_SCORE"), F.lit("fair").alias("CREDIT_RATING")).alias("CREDIT_SCORE_SUMMARY"))
    # One report per client and day, so that the newest is a single one.
    newest = loans(spark, d).groupBy("client_id", "disbursed_on").agg(F.max("loan_id").alias("loan_id")).withColumn("matures_on", F.date_add("disbursed_on", 30))
    return newest.select("client_id", F.col("disbursed_on").alias("created_at"), F.to_json(F.struct(F.struct(body.alias("BODY")).alias("ConsumerHitResponse"))).alias("report"))


CTE["newest_report"] = """select client_id, max(loan_id) as loan_id, disbursed_on, disbursed_on + 30 as matures_on from loans l
    where disbursed_on = (select max(disbursed_on) from loans m where m.client_id = l.client_id) group by client_id, disbursed_on"""


@query("bureau_facilities", """
select client_id, loan_id || '/' || i as account_number, i * 1000 + 200.5::double as amount_overdue_cal, 'lost' as asset_classification_cal, 1000::double as current_balance_cal,
  cast(disbursed_on as varchar) as date_reported, 'bank ' || i as institution_name, '3' as date_reported_age, 'open' as loan_status, 'personal' as loan_type_value,
  cast(matures_on as varchar) as maturity_dt, i * 30 as num_of_days_in_arrears_cal
from (select *, unnest(range(1, loan_id % 4 + 1)) as i from newest_report)""", ("loans", "newest_report"))
def bureau_facilities(spark, d):
    return bureau_rules.section_rows(_bodies(spark, d), "facilities").withColumn("num_of_days_in_arrears_cal", F.col("num_of_days_in_arrears_cal").cast("long"))


@query("bureau_performance", """
select client_id, n * 1000::double as facilities_count, name as institution_name, '0' as nonperforming_facility, 12345.5::double as overdue_amount, cast(n as varchar) as performing_facility
from (select client_id, 'first' as name, loan_id % 7 + 1 as n from newest_report union all select client_id, 'second', loan_id % 5 + 1 from newest_report)""", ("loans", "newest_report"))
def bureau_performance(spark, d):
    return bureau_rules.section_rows(_bodies(spark, d), "performance")


@query("bureau_details", """
select client_id, case when loan_id % 2 = 0 then 'N' || loan_id end as cir_number, case when loan_id % 2 = 0 then cast(disbursed_on as varchar) end as report_order_date,
  cast(loan_id % 850 as varchar) as credit_score, 'fair' as credit_rating from newest_report""", ("loans", "newest_report"))
def bureau_details(spark, d):
    reports = _bodies(spark, d)
    return bureau_rules.report_details(reports, "report").join(bureau_rules.report_details(reports, "score"), "client_id")


_DECIDED = (*_SALARY, "loans", "debt", "salary_limits", "features", "clients", "tenor", "tenure", "decided")
CTE["decided"] = """select s.*, coalesce(n.n, 0) as count_of_loans, t.passes as tenure_passes, f.client_id is null or (f.total_no_of_facilities <= 5 and f.maximum_days_in_arrears < 60
      and f.total_overdue_amount < s.average_monthly_6m and f.no_of_institution_types <= 2) as bureau_qualified,
    f.client_id is null or (f.total_no_of_facilities <= 5 and f.maximum_days_in_arrears < 90 and f.total_overdue_amount < s.average_monthly_3m and f.no_of_institution_types <= 3 and f.at_deposit_bank) as payday_bureau_qualified
    from salary_limits s left join features f using (client_id) join (select *, had_six_months or (is_complete and is_consecutive and is_recent) as passes from tenure) t using (client_id)
    left join (select client_id, count(*) as n from tenor where product_id = 18 group by 1) n using (client_id)"""


def _decided(spark, d):
    rules = salary.tenure_rules(clients(spark, d), _tenor(spark, d), AS_OF).select("client_id", F.col("passes").alias("tenure_passes"))
    out = bureau_rules.bureau_rules(_salary_limits(spark, d), bureau_rules.report_features(_reports(spark, d), BANKS))
    return out.join(rules, "client_id").join(salary.loan_counts(clients(spark, d), _tenor(spark, d), [18]), "client_id")


@query("bureau_rules", "select client_id, bureau_qualified, payday_bureau_qualified from decided", _DECIDED)
def bureau_rule_check(spark, d):
    return _decided(spark, d).select("client_id", "bureau_qualified", "payday_bureau_qualified")


@query("limits_to_share", """
select client_id, case when is_3m_qualified then limit_3m else 0 end as limit_to_share_3m, cast(case when is_3m_qualified then 3 else -1 end as bigint) as tenure_3m,
  case when is_6m_qualified and count_of_loans > 2 then limit_6m else 0 end as limit_to_share_6m, cast(case when is_6m_qualified and count_of_loans > 2 then 6 else -1 end as bigint) as tenure_6m,
  case when is_1m_qualified then limit_1m else 0 end as payday_limit_to_share from decided""", _DECIDED)
def limits_to_share(spark, d):
    out = salary.shared_limits(_decided(spark, d))
    return out.select("client_id", "limit_to_share_3m", F.col("tenure_3m").cast("long").alias("tenure_3m"), "limit_to_share_6m",
                      F.col("tenure_6m").cast("long").alias("tenure_6m"), "payday_limit_to_share")


@query("salary_narrations", """
with texts as (select * from (values (' B005', 'Client has not received consistent salary payment in recent months'), ('B005', 'Client has not received consistent salary payment in recent months'),
  ('C005', 'inadequate payment history to check'), ('C004', 'Client has high debt exposure'), (' D006', 'Client has high number of running loans'),
  (' F001', 'Limits assigned per lending criteria '), (' D001', 'Limits assigned less than product thresholds'), ('Employer not eligible', 'Employer not eligible')) t(code, words))
select c.*, a.words as rules_summary, b.words as payday_rules_summary from (select client_id, case when not is_qualified_on_salaries then ' B005' when not bureau_qualified then 'C005' when not latest_covers_minimum then ' B005' when debt_share > 0.5 then 'C004'
  when count_of_running_loans > 5 then ' D006' when (limit_6m > 0 or limit_3m > 0) and bureau_qualified and (is_3m_qualified or (is_6m_qualified and tenure_passes)) then ' F001' else ' D001' end as reason_code,
  case when not (is_government or is_multinational) then 'Employer not eligible' when not payday_is_qualified_on_salaries then ' B005' when not payday_bureau_qualified then 'C005'
  when not payday_latest_covers_minimum then 'B005' when payday_debt_share > 0.5 then 'C004' when count_of_running_loans > 5 then ' D006' when limit_1m > 0 and is_1m_qualified then ' F001' else ' D001' end as payday_reason_code
from decided) c join texts a on a.code = c.reason_code join texts b on b.code = c.payday_reason_code""", _DECIDED)
def salary_narrations(spark, d):
    return salary.narrations(_decided(spark, d)).select("client_id", "reason_code", "payday_reason_code", "rules_summary", "payday_rules_summary")


@query("publish_limits", """
select client_id, case when is_3m_qualified then limit_3m else -1 end as final_limit, case when is_3m_qualified then limit_6m else -1 end as final_limit_6m from salary_limits""", (*_SALARY, "loans", "debt", "salary_limits"))
def publish_limits(spark, d):
    return publishing.publishable(_salary_limits(spark, d), {"final_limit": "limit_3m", "final_limit_6m": "limit_6m"}, "is_3m_qualified", ["client_id"], -1.0)
