"""Plain relational queries over the star schema and the event table."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lamplight.plans.registry import query
from lamplight.session import table


@query("""
    SELECT n_name, o_orderpriority, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY ALL""")
def k_join_chain(spark, d):
    """Revenue of one region by nation and priority."""
    t = lambda n: table(spark, d, n)
    nations = t("nation").join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    sold = t("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderpriority", "n_name")
    rows = t("lineitem").join(sold, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("n_name", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity, round(avg(l_discount), 4) AS discount FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def k_rollup(spark, d):
    """Totals by return flag and line status, with subtotals."""
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.round(F.avg("l_discount"), 4).alias("discount"))


@query("SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC)::INT AS rank FROM orders) WHERE rank <= 3")
def k_window_rank(spark, d):
    """Each customer's three largest orders."""
    rank = F.rank().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice")))
    return table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice").withColumn("rank", rank).where("rank <= 3")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def k_semi_anti(spark, d):
    """Customers with a large order and none of a certain status."""
    orders = table(spark, d, "orders")
    big = table(spark, d, "customer").join(orders.where("o_totalprice > 100000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    return big.join(orders.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT s_nationkey AS nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal < 0")
def k_set_ops(spark, d):
    """Nations with suppliers and with customers in debt."""
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey")).intersect(table(spark, d, "customer").where("c_acctbal < 0").select("c_nationkey"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def k_event_windows(spark, d):
    """Events by hour and type."""
    from lamplight.streaming.drain import windowed_counts

    counts = windowed_counts(table(spark, d, "events"), "ts", "event_type")
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
