"""Session records derived from order tables: one order is one session."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartsight.schema import KEYED_SCHEMA, MONTHS, PAGE_GROUPS


def shop_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """``KEYED_SCHEMA`` rows from the orders, customer and lineitem tables in ``folder``.

    Lines are pre-aggregated per order before any join.  The customer join comes
    first, so that its output is shuffled on the order key anyway and adaptive
    execution is free to split a customer who placed very many orders.  The last
    join reuses the shuffle of the aggregate and leaves the rows partitioned by
    ``session_id``.
    """
    orders, customer, lineitem = (
        spark.read.parquet(f"{folder}/{name}.parquet") for name in ("orders", "customer", "lineitem")
    )
    visits = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        *_per_group(),
        F.sum(_hundredths("l_discount")).alias("discount"),
        F.sum(_hundredths("l_tax")).alias("tax"),
        F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)).alias("filled"),
    )
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    sessions = placed.join(visits.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    page_values = F.col("filled") / F.col("n")
    priority = F.col("o_orderpriority")
    columns = {
        "session_id": F.col("o_orderkey"),
        **{c: F.col(c) for group in PAGE_GROUPS for c in (group, f"{group}_Duration")},
        "BounceRates": F.col("discount").cast("double") / (F.col("n") * 100),
        "ExitRates": F.col("tax").cast("double") / (F.col("n") * 100),
        "PageValues": page_values,
        "SpecialDay": (F.dayofmonth("o_orderdate") % 6).cast("double") / 5,
        "Month": F.element_at(F.array(*map(F.lit, MONTHS)), F.month("o_orderdate")),
        "OperatingSystems": F.col("o_custkey") % 8 + 1,
        "Browser": F.col("o_orderkey") % 13 + 1,
        "Region": F.col("c_nationkey") % 9 + 1,
        "TrafficType": (F.col("o_orderkey") + F.col("o_custkey")) % 20 + 1,
        "VisitorType": F.when(priority == "1-URGENT", "New_Visitor")
        .when(priority == "5-LOW", "Other")
        .otherwise("Returning_Visitor"),
        "Weekend": F.dayofweek("o_orderdate").isin(1, 7),
        "Revenue": F.col("o_totalprice") > 400000 - 4000 * page_values,
    }
    return sessions.select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in KEYED_SCHEMA.fields)
    )


def _per_group():
    for flag, group in zip("ANR", PAGE_GROUPS):
        hit = F.col("l_returnflag") == flag
        yield F.count_if(hit).alias(group)
        yield F.sum(F.when(hit, F.col("l_quantity")).otherwise(0.0)).alias(f"{group}_Duration")


def _hundredths(column: str):
    return F.round(F.col(column) * 100).cast("bigint")
