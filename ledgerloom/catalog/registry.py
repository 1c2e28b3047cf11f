"""Registration of queries and the table bindings they share.

Bindings only rename and derive columns row by row, so that an operator meets
lending columns; every query reads whole tables. ``CTE`` holds the same
bindings as SQL.
"""
from pyspark.sql import functions as F

from ledgerloom.sources.readers import table  # noqa: F401

QUERIES: dict = {}
ORACLES: dict = {}

AS_OF = "2001-08-01"        # day after the last order
EVENTS_AS_OF = "2024-01-31"  # day after the last event


def query(name: str, sql: str | None = None, ctes: tuple = ()):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            head = ", ".join(f"{c} as ({CTE[c]})" for c in ctes)
            body = sql.strip()
            if head and body.lower().startswith("with "):
                body = f"with {head}, {body[5:]}"
            elif head:
                body = f"with {head} {body}"
            ORACLES[name] = body
        return fn
    return register


def money(c) -> F.col:
    """Amounts as decimals short enough for products to stay in 18 digits."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def clients(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("client_id"), F.col("c_name").alias("client_name"), F.col("c_nationkey").alias("office_id"),
        money("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))


def loans(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("loan_id"), F.col("o_custkey").alias("client_id"),
        F.when(F.col("o_orderstatus") == "F", 600).when(F.col("o_orderstatus") == "O", 300).otherwise(700).alias("loan_status"),
        money("o_totalprice").alias("principal"), day.alias("disbursed_on"), F.date_add(day, 30).alias("matures_on"),
        F.col("o_orderpriority").alias("channel"))


def repayments(spark, d):
    """Money in per loan. Amounts stay decimals, so sums do not depend on order."""
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("loan_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("staff_id"),
        (money("l_extendedprice") * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("amount"),
        money("l_quantity").alias("fee"), F.to_date("l_shipdate").alias("paid_on"),
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("line_status"))


def activity(spark, d):
    """Events as agent activity: an error is a refused request, a purchase a
    commission; the balance is what is left after a fixed charge."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select(
        F.col("user_id").alias("agent_id"), F.col("ts"), F.col("event_id").alias("request_ref"),
        F.when(F.col("event_type") == "error", "Declined").otherwise("Approved").alias("status"),
        F.when(F.col("event_type") == "purchase", "Agent Commission").otherwise(F.col("event_type")).alias("biller"),
        F.concat(F.lit("service "), (k % 7).cast("string")).alias("narration"),
        (money("value") * 5000).alias("debit"), money("value").alias("credit"), (money("value") - k).alias("balance"), k.alias("k"))


CTE = {
    "clients": """select c_custkey as client_id, c_name as client_name, c_nationkey as office_id,
        cast(c_acctbal as decimal(18,2)) as balance, c_mktsegment as segment from customer""",
    "loans": """select o_orderkey as loan_id, o_custkey as client_id,
        case o_orderstatus when 'F' then 600 when 'O' then 300 else 700 end as loan_status,
        cast(o_totalprice as decimal(18,2)) as principal, cast(o_orderdate as date) as disbursed_on,
        cast(o_orderdate as date) + 30 as matures_on, o_orderpriority as channel from orders""",
    "repayments": """select l_orderkey as loan_id, l_linenumber as line, l_partkey as part_id, l_suppkey as staff_id,
        cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(4,2))) as amount,
        cast(l_quantity as decimal(18,2)) as fee, cast(l_shipdate as date) as paid_on, l_returnflag as flag,
        l_linestatus as line_status from lineitem""",
    "activity": """select user_id as agent_id, ts, event_id as request_ref,
        case when event_type = 'error' then 'Declined' else 'Approved' end as status,
        case when event_type = 'purchase' then 'Agent Commission' else event_type end as biller,
        'service ' || (k % 7) as narration, cast(value as decimal(18,2)) * 5000 as debit,
        cast(value as decimal(18,2)) as credit, cast(value as decimal(18,2)) - k as balance, k
        from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)""",
}
