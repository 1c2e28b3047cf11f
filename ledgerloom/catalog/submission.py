"""Bureau submission records and whitelist changes."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import CTE, clients, loans, query, repayments, table
from ledgerloom.plans import bureau_submission as submission, limits

DAY = dt.date(2001, 8, 1)

CTE.update({
    "book": """select *, case when loan_status = 600 then 0 else floor(cast(principal as double) / 2) end as total_outstanding,
        case loan_id % 3 when 1 then floor(cast(principal as double) / 4) when 2 then 0 end as partner_balance,
        case when loan_id % 2 = 0 then date '2001-07-31' else date '2001-07-27' end as partner_balance_date,
        case when loan_status <> 300 then disbursed_on + 20 end as closed_on, case when loan_id % 4 = 0 then '1' else '2' end as version, loan_id % 20 as product_id from loans""",
    "lines": """select l_orderkey as loan_id, l_linenumber as transaction_id, cast(l_shipdate as date) as transaction_date, cast(l_extendedprice as decimal(18,2)) as amount,
        case when l_linestatus = 'F' then 2 else 1 end as transaction_type, l_linenumber as installment, cast(l_shipdate as date) as due_date,
        case when l_returnflag = 'A' then 1 else 0 end as completed, cast(l_extendedprice as decimal(18,2)) as principal_amount, cast(l_quantity as decimal(18,2)) as interest_amount from lineitem""",
    "records": """select b.*, case when balance = 0 then 0 else greatest(coalesce(date '2001-08-01' - o.since, 0), 0) end as days_in_arrears,
        case when balance = 0 then 0 else coalesce(cast(o.total as double), 0) end as overdue_balance, case when balance = 0 then 0 else coalesce(s.overdue, 0) end as instalments_in_arrears,
        case when balance <> 0 and o.since is not null then o.since end as overdue_date, coalesce(cast(s.first_row.amount as double), 0) as instalment_amount,
        coalesce(s.next_row.due_date, b.matures_on) as next_instalment_date, p.transaction_date as last_payment_date, coalesce(floor(cast(p.amount as double)), 0) as last_payment_amount,
        case when balance <> 0 and o.since is not null then o.since when loan_status = 300 then disbursed_on else coalesce(closed_on, disbursed_on) end as account_status_date
      from (select *, greatest(case when partner_balance is not null and (partner_balance_date > date '2001-07-30' or partner_balance = 0) then partner_balance else total_outstanding end, 0) as balance from book) b
      left join (select loan_id, x.d as transaction_date, x.a as amount from (select loan_id, max({'t': transaction_id, 'd': transaction_date, 'a': amount}) as x from lines where transaction_type = 2 group by 1)) p using (loan_id)
      left join (select loan_id, min({'i': installment, 'd': due_date, 'amount': principal_amount + interest_amount}) as first_row, min({'i': installment, 'due_date': due_date}) filter (where completed = 0) as next_row,
        count(*) filter (where completed = 0 and due_date <= date '2001-08-01') as overdue from lines group by 1) s using (loan_id)
      left join (select loan_id, min(due_date) as since, sum(amount) as total from lines where completed = 0 group by 1) o using (loan_id)""",
})


def _book(spark, d):
    p, k = F.col("principal").cast("double"), F.col("loan_id")
    return loans(spark, d).withColumns({
        "total_outstanding": F.when(F.col("loan_status") == 600, 0.0).otherwise(F.floor(p / 2).cast("double")),
        "partner_balance": F.when(k % 3 == 1, F.floor(p / 4).cast("double")).when(k % 3 == 2, 0.0),
        "partner_balance_date": F.when(k % 2 == 0, F.lit(dt.date(2001, 7, 31))).otherwise(F.lit(dt.date(2001, 7, 27))),
        "closed_on": F.when(F.col("loan_status") != 300, F.date_add("disbursed_on", 20)),
        "version": F.when(k % 4 == 0, "1").otherwise("2"), "product_id": k % 20})


def _lines(spark, d):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("loan_id"), F.col("l_linenumber").alias("transaction_id"), F.to_date("l_shipdate").alias("transaction_date"), price.alias("amount"),
        F.when(F.col("l_linestatus") == "F", 2).otherwise(1).alias("transaction_type"), F.col("l_linenumber").alias("installment"), F.to_date("l_shipdate").alias("due_date"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("completed"), price.alias("principal_amount"), F.col("l_quantity").cast("decimal(18,2)").alias("interest_amount"),
        F.lit(None).cast("decimal(18,2)").alias("fee_amount"), F.lit(None).cast("decimal(18,2)").alias("penalty_amount"))


def _records(spark, d):
    lines = _lines(spark, d)
    arrears = lines.filter("completed = 0").groupBy("loan_id").agg(F.min("due_date").alias("overdue_since"), F.sum("amount").alias("total_overdue"))
    return submission.loan_records(_book(spark, d), lines.select("loan_id", "transaction_id", "transaction_date", "amount", "transaction_type"),
                                   lines.select("loan_id", "installment", "due_date", "completed", "principal_amount", "interest_amount", "fee_amount", "penalty_amount"), arrears, DAY)


@query("bureau_record", """
select loan_id, cast(balance as double) as current_balance, cast(days_in_arrears as bigint) as days_in_arrears, cast(overdue_balance as double) as overdue_balance, cast(instalments_in_arrears as bigint) as instalments_in_arrears,
  overdue_date, instalment_amount, next_instalment_date, last_payment_date, cast(last_payment_amount as double) as last_payment_amount,
  case when days_in_arrears = 0 then 'A' when days_in_arrears <= 30 then 'B' when days_in_arrears <= 60 then 'C' when days_in_arrears <= 90 then 'D' else 'E' end as classification,
  case when balance = 0 then 'A' when loan_status = 300 then case when days_in_arrears > 60 then 'E' else 'F' end else 'F' end as account_status, account_status_date from records""", ("loans", "book", "lines", "records"))
def bureau_record(spark, d):
    return _records(spark, d).select("loan_id", "current_balance", "days_in_arrears", "overdue_balance", "instalments_in_arrears", "overdue_date", "instalment_amount",
                                     "next_instalment_date", "last_payment_date", "last_payment_amount", "classification", "account_status", "account_status_date")


CTE["submitted"] = """select loan_id, upper(substr(sn, 1, 1)) || lower(substr(sn, 2)) as surname, upper(substr(f1, 1, 1)) || lower(substr(f1, 2)) as forename_1,
    upper(substr(f2, 1, 1)) || lower(substr(f2, 2)) as forename_2, gender, id_type, case when id_type = '001' then regexp_replace(idn, '[^\\p{L}\\p{N}]', '', 'g') else idn end as id_number,
    case when age < 18 or age > 99 then date '1970-10-10' else birth end as date_of_birth, mobile as mobile_number, original, balance, least(overdue_balance, balance) as overdue, instalment_amount, last_payment_amount,
    days_in_arrears, instalments_in_arrears, account_status_date, disbursed_on, overdue_date from (
    select r.loan_id, r.balance, r.overdue_balance, r.instalment_amount, r.last_payment_amount, r.days_in_arrears, r.instalments_in_arrears, r.account_status_date, r.disbursed_on, r.overdue_date,
      floor(cast(r.principal as double) / 100) as original, regexp_replace(c.segment, '[^\\p{L}]', '', 'g') as f1,
      regexp_replace(case when c.client_id % 3 > 0 then 'Kim ' || c.segment end, '[^\\p{L}]', '', 'g') as f2,
      regexp_replace(coalesce(case c.client_id % 10 when 0 then null when 1 then null else c.client_name end, case when c.client_id % 3 > 0 then 'Kim ' || c.segment end), '[^\\p{L}]', '', 'g') as sn,
      case c.client_id % 4 when 0 then 'M' when 1 then 'F' when 2 then 'F' end as gender, case when c.client_id % 6 = 0 then '002' else '001' end as id_type,
      case when c.client_id % 6 = 0 then 'P-' || c.client_id when c.client_id % 6 = 1 then '12-' || c.client_id else cast(c.client_id as varchar) end as idn,
      date '2001-08-01' - cast((c.client_id % 120) * 365 + 5 as integer) as birth, (c.client_id % 120) as age, '2547' || c.client_id as mobile
    from records r join clients c using (client_id))"""


def _to_submit(spark, d):
    key = F.col("client_id")
    who = clients(spark, d).select(
        "client_id", F.when(key % 10 == 0, "").when(key % 10 == 1, "x").otherwise(F.col("client_name")).alias("surname"), F.col("segment").alias("forename_1"),
        F.when(key % 3 == 0, "J").otherwise(F.concat(F.lit("Kim "), F.col("segment"))).alias("forename_2"),
        submission.gender_code(F.when(key % 4 == 0, "Male").when(key % 4 == 2, "Male"), F.when(key % 4 == 1, "Female").when(key % 4 == 2, "Female")).alias("gender"),
        F.when(key % 6 == 0, F.concat(F.lit("P-"), key.cast("string"))).when(key % 6 == 1, F.concat(F.lit("12-"), key.cast("string"))).otherwise(key.cast("string")).alias("id_number"),
        F.date_sub(F.lit(DAY), ((key % 120) * 365 + 5).cast("int")).alias("date_of_birth"), F.concat(F.lit("2547"), key.cast("string"), F.lit("_old")).alias("mobile_number"))
    return _records(spark, d).join(who, "client_id").select(
        "loan_id", "surname", "forename_1", "forename_2", "gender", "id_number", "date_of_birth", "mobile_number", F.floor(F.col("principal").cast("double") / 100).cast("double").alias("original_amount"),
        "current_balance", "overdue_balance", "instalment_amount", "last_payment_amount", "days_in_arrears", "instalments_in_arrears", "classification", "account_status",
        "account_status_date", "overdue_date", F.col("disbursed_on").alias("disbursement_date"), submission.term_months(F.col("loan_id") % 12, F.col("loan_id") % 3).cast("string").alias("repayment_period"))


_SUB = ("clients", "loans", "book", "lines", "records", "submitted")
_KEPT = "(original >= 1000 or balance = 0) and original <> 0"


@query("submission_records", f"""
select loan_id, surname, forename_1, forename_2, gender, id_type, id_number, date_of_birth, mobile_number, replace(format('{{:.2f}}', original), '.', '') as original_amount,
  replace(format('{{:.2f}}', cast(balance as double)), '.', '') as current_balance, replace(format('{{:.2f}}', cast(overdue as double)), '.', '') as overdue_balance,
  replace(format('{{:.2f}}', instalment_amount), '.', '') as instalment_amount from submitted where {_KEPT} and gender is not null and surname is not null""", _SUB)
def submission_records(spark, d):
    good, _, _ = submission.clean_records(_to_submit(spark, d), DAY)
    return good.select("loan_id", "surname", "forename_1", "forename_2", "gender", "id_type", "id_number", "date_of_birth", "mobile_number", "original_amount",
                       "current_balance", "overdue_balance", "instalment_amount")


@query("submission_small", "select loan_id, original as original_amount, cast(balance as double) as current_balance from submitted where original < 1000 and balance <> 0", _SUB)
def submission_small(spark, d):
    _, small, _ = submission.clean_records(_to_submit(spark, d), DAY)
    return small.select("loan_id", "original_amount", "current_balance")


@query("submission_exceptions", f"""
select loan_id, 'surname' as exception_column from submitted where {_KEPT} and surname is null and balance <> 0
union all select loan_id, 'gender' from submitted where {_KEPT} and gender is null and balance <> 0""", _SUB)
def submission_exceptions(spark, d):
    _, _, bad = submission.clean_records(_to_submit(spark, d), DAY)
    return bad.select("loan_id", "exception_column")


_SELECTORS = {
    "closed": submission.Portfolio("closed", "1", (600,)),
    "partner": submission.Portfolio("partner", "2", disbursed_from="1998-01-01", balance="partner_or_settled", test_clients=(11, 12)),
    "core_only": submission.Portfolio("core_only", "2", disbursed_from="1998-01-01", balance="core_only"),
    "products": submission.Portfolio("products", products=(2, 3, 7, 11, 14, 18)),
}


@query("portfolio_selectors", """
with kept as (select * from book where loan_id not in (select loan_id from repayments where line = 7))
select 'closed' as portfolio, loan_id, client_name from kept join clients using (client_id) where version = '1' and loan_status = 600 and total_outstanding is not null
union all select 'partner', loan_id, client_name from kept join clients using (client_id) where version = '2' and disbursed_on >= date '1998-01-01' and client_id not in (11, 12) and (partner_balance is not null or total_outstanding = 0)
union all select 'core_only', loan_id, client_name from kept join clients using (client_id) where version = '2' and disbursed_on >= date '1998-01-01' and total_outstanding > 0 and partner_balance is null
union all select 'products', loan_id, client_name from kept join clients using (client_id) where product_id in (2, 3, 7, 11, 14, 18)""", ("loans", "clients", "repayments", "book"))
def portfolio_selectors(spark, d):
    book, who = _book(spark, d), clients(spark, d).select("client_id", "client_name")
    excluded = repayments(spark, d).filter("line = 7").select("loan_id")
    return submission.select_portfolios(book, who, _SELECTORS, excluded).select("portfolio", "loan_id", "client_name")


CTE["old_list"] = """select case client_id % 5 when 0 then '00' || client_id when 1 then client_id || '.0' else cast(client_id as varchar) end as raw_number, client_id, cast(client_id % 2 as bigint) as blacklist_flag,
    cast(client_id % 1000 as double) as limit_1, cast(client_id % 700 as double) as limit_7, cast(client_id % 300 as double) as limit_21 from clients where client_id % 11 <> 0"""
CTE["new_list"] = """select cast(client_id as varchar) as store_number, client_id, case when client_id % 13 = 0 then 1 else cast(client_id % 2 as bigint) end as blacklist_flag,
    case when client_id % 3 = 0 then client_id % 1000 + 10 else client_id % 1000 end::double as limit_1, cast(client_id % 700 as double) as limit_7,
    case when client_id % 4 = 0 then client_id % 300 - 5 else client_id % 300 end::double as limit_21 from clients where client_id % 7 <> 0"""


def _lists(spark, d):
    k = F.col("client_id")
    key = k.cast("string")
    old = clients(spark, d).filter(k % 11 != 0).select(
        F.when(k % 5 == 0, F.concat(F.lit("00"), key)).when(k % 5 == 1, F.concat(key, F.lit(".0"))).otherwise(key).alias("store_number"), (k % 2).alias("blacklist_flag"),
        (k % 1000).cast("double").alias("limit_1"), (k % 700).cast("double").alias("limit_7"), (k % 300).cast("double").alias("limit_21"))
    new = clients(spark, d).filter(k % 7 != 0).select(
        key.alias("store_number"), F.lit("v2").alias("model_version"), F.when(k % 13 == 0, 1).otherwise(k % 2).alias("blacklist_flag"),
        F.when(k % 3 == 0, k % 1000 + 10).otherwise(k % 1000).cast("double").alias("limit_1"), (k % 700).cast("double").alias("limit_7"),
        F.when(k % 4 == 0, k % 300 - 5).otherwise(k % 300).cast("double").alias("limit_21"))
    return old, new


CTE["changes"] = """select coalesce(n.store_number, o.key) as store_number, case when n.store_number is null then 'zeroise' when o.key is not null then
      case when o.blacklist_flag <> n.blacklist_flag or o.limit_1 <> n.limit_1 or o.limit_7 <> n.limit_7 or o.limit_21 <> n.limit_21 then 'update' else 'unchanged' end
      when ltrim(n.store_number, '0') not in (select ltrim(trim(raw_number), '0') from old_list) then 'insert' else 'skip' end as action,
    case when o.blacklist_flag > n.blacklist_flag then 'whitelist' when o.blacklist_flag < n.blacklist_flag then 'blacklist' end as blacklist_flag_change,
    case when o.limit_1 > n.limit_1 then 'negative' when o.limit_1 < n.limit_1 then 'positive' end as limit_1_change, case when o.limit_21 > n.limit_21 then 'negative' when o.limit_21 < n.limit_21 then 'positive' end as limit_21_change,
    cast(case when n.limit_21 > 0 then 1 else 0 end as bigint) as has_limit_21, cast(case when o.limit_1 < n.limit_1 then 1 else 0 end as bigint) as has_positive_limit_1_change,
    cast(case when o.limit_21 > n.limit_21 then 1 else 0 end as bigint) as has_negative_limit_21_change
  from (select *, regexp_replace(raw_number, '\\.0$', '') as key from old_list) o full join new_list n on o.key = n.store_number"""


@query("whitelist_diff", "select * from changes where action <> 'skip'", ("clients", "old_list", "new_list", "changes"))
def whitelist_diff(spark, d):
    out = limits.whitelist_changes(*_lists(spark, d), "v2")
    return out.select("store_number", "action", "blacklist_flag_change", "limit_1_change", "limit_21_change",
                      *[F.col(c).cast("long").alias(c) for c in ("has_limit_21", "has_positive_limit_1_change", "has_negative_limit_21_change")])


@query("whitelist_summary", "select 'v2' as model_version, count(*) filter (where action = 'insert') as total_inserts, count(*) filter (where action = 'update') as total_updates from changes",
       ("clients", "old_list", "new_list", "changes"))
def whitelist_summary(spark, d):
    return limits.push_summary(limits.whitelist_changes(*_lists(spark, d), "v2"))
