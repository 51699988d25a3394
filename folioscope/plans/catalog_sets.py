"""Queries of set tests, reports of times and sizes, sorts and numberings over whole tables."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.operators import digest, merge
from folioscope.plans.catalog import _H, _headings, _orders, query
from folioscope.session import table
from folioscope.sources import sinks


@query("SELECT count(*) AS missing, count(*) = 0 AS covered FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'))")
def universe_covered(spark, d):
    have = table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return merge.missing(_orders(spark, d), have, "o_custkey")


@query("SELECT n_nationkey, n_name, CAST(row_number() OVER (ORDER BY CASE WHEN n_regionkey = 1 THEN 0 ELSE 1 END, CASE WHEN n_regionkey = 1 THEN n_name END, n_nationkey) - 1 AS INTEGER) AS place FROM nation")
def tabs_after_targets(spark, d):
    n = table(spark, d, "nation")
    first = n.where("n_regionkey = 1").select("n_nationkey", F.row_number().over(W.orderBy("n_name")).alias("o"))
    return sinks.targets_first(n, first, "n_nationkey", "o", "n_nationkey").select("n_nationkey", "n_name", "place")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O' AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def shared_keys(spark, d):
    o = _orders(spark, d)
    return merge.shared(o.where("o_orderstatus = 'O'"), o.where("o_orderstatus = 'F'"), "o_custkey")


@query("SELECT event_id, value FROM events ORDER BY value DESC NULLS LAST, event_id LIMIT 10")
def slowest_ten(spark, d):
    return table(spark, d, "events").orderBy(F.desc_nulls_last("value"), "event_id").limit(10).select("event_id", "value")


@query(f"WITH {_H} SELECT conv_id, idx, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY page, CASE WHEN idx % 3 = 0 THEN 0 ELSE idx END, level, idx) AS INTEGER) AS place FROM h")
def tree_order(spark, d):
    line = F.when(F.col("idx") % 3 != 0, F.col("idx"))
    h = _headings(spark, d).withColumn("line", line)
    by = W.partitionBy("conv_id").orderBy("page", F.coalesce("line", F.lit(0)), "level", "idx")
    return h.select("conv_id", "idx", F.row_number().over(by).alias("place"))


@query("SELECT user_id, min(t) AS first_time, max(t) AS last_time FROM (SELECT user_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS t FROM events) GROUP BY 1")
def page_time_range(spark, d):
    t = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    return table(spark, d, "events").groupBy("user_id").agg(F.min(t).alias("first_time"), F.max(t).alias("last_time"))


@query("SELECT event_type, count(*) FILTER (value >= 120) AS very_slow, count(*) AS n FROM events GROUP BY 1")
def very_slow_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") >= 120).alias("very_slow"), F.count(F.lit(1)).alias("n"))


@query("SELECT p_brand, coalesce(avg(CASE WHEN p_size % 3 <> 0 THEN p_size END), 0.0)::DOUBLE AS size FROM part GROUP BY 1")
def mean_font_size(spark, d):
    size = F.when(F.col("p_size") % 3 != 0, F.col("p_size"))
    return table(spark, d, "part").groupBy("p_brand").agg(F.coalesce(F.avg(size), F.lit(0.0)).alias("size"))


@query("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders")
def rank_all(spark, d):
    return digest.ranked(_orders(spark, d), [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "rank")


@query("SELECT CAST(o_custkey AS VARCHAR) AS key, CAST(max(r) + 1 AS INTEGER) AS row FROM (SELECT o_custkey, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) GROUP BY 1")
def sheet_rows(spark, d):
    return sinks.key_rows(_orders(spark, d).select(F.col("o_custkey").cast("string").alias("key"), "o_orderkey"), "o_orderkey")


@query("SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 2 = 0 THEN 'new ' || c_name ELSE c_name END AS stock_name, CASE WHEN c_custkey % 3 <> 0 THEN 'note' END AS notes FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0")
def tab_synced(spark, d):
    """Known keys get the program's columns and keep what people wrote; new ones are appended."""
    c = table(spark, d, "customer").withColumn("key", F.col("c_custkey").cast("string"))
    own = lambda *cols: [dict(zip(("stock_name", "notes"), cols, strict=True)).get(n, F.lit(None).cast("string")).alias(n) for n in (*sinks.PROGRAM_COLUMNS, *sinks.MANUAL_COLUMNS) if n != "key"]
    tab = c.where("c_custkey % 3 <> 0").select("key", *own(F.col("c_name"), F.lit("note")))
    rows = c.where("c_custkey % 2 = 0").select("key", *own(F.concat(F.lit("new "), F.col("c_name")), F.lit(None).cast("string")))
    return sinks.sync_tab(tab, rows).select("key", "stock_name", "notes")
