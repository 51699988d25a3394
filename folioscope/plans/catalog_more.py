"""More queries of the catalog: projections, arithmetic, arrays, headings, line and candidate filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from folioscope.functions import keys as K
from folioscope.functions import numbers as N
from folioscope.functions import text as X
from folioscope.functions import times as T
from folioscope.operators import latest, merge, search, tree
from folioscope.plans.catalog import _H, _LINES, _PARENT, KEYWORDS, _docs, _headings, _lines, _lit, _orders, query
from folioscope.sources import readers
from folioscope.session import table


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def write_projection(spark, d):
    return merge.project_to(_orders(spark, d), ["o_orderkey", "not_there", "o_custkey", "o_orderdate"])


@query(" UNION ALL ".join(f"SELECT doc_id, {_lit(k)} AS keyword, CAST({w} AS INTEGER) AS weight FROM documents WHERE contains(coalesce(text, ''), {_lit(k)})" for k, w, _ in KEYWORDS))
def keyword_contains(spark, d):
    return search.keyword_pairs(_docs(spark, d), "text", [(k, w) for k, w, _ in KEYWORDS])


@query("WITH h AS (SELECT l_orderkey, l_returnflag, CAST(l_linenumber * CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END AS INTEGER) AS w, l_linestatus AS s, l_linenumber AS a, l_suppkey AS b, l_quantity AS c, l_extendedprice AS d FROM lineitem), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY abs(w) DESC, a, b, c, d, s) AS k, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY a, b, c, d, s) AS n FROM h) SELECT l_orderkey, l_returnflag, count(*) AS count, max(w) FILTER (k = 1) AS weight, CASE WHEN bool_or(s = 'F') THEN 'neg' ELSE 'pos' END AS polarity, max(s) FILTER (n = 1) AS context FROM r GROUP BY 1, 2")
def hits_rolled_up(spark, d):
    li = table(spark, d, "lineitem")
    w = (F.col("l_linenumber") * F.when(F.col("l_linestatus") == "F", -1).otherwise(1)).cast("int")
    h = li.withColumn("w", w).withColumn("p", F.when(F.col("l_linestatus") == "F", "neg").otherwise("pos"))
    return latest.rolled_up(h, ["l_orderkey", "l_returnflag"], "w", "p", "l_linestatus", ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus"])


@query("SELECT c_custkey, CASE WHEN contains(c_mktsegment, 'BUILD') OR contains('BUILD', c_mktsegment) THEN 0.15 WHEN contains(c_mktsegment, 'AUTO') THEN 0.5 ELSE 1.0 END::DOUBLE AS multiplier FROM customer")
def industry_multipliers(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", N.industry_multiplier(F.array("c_mktsegment"), [(("BUILD",), 0.15), (("AUTO", "BUILD"), 0.5), (("HOUSE",), -1.0)]).alias("multiplier"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, CAST(trunc(l_quantity * 0.1) AS INTEGER) AS points, -greatest(1, CAST(trunc(l_linenumber * 0.5::DOUBLE) AS INTEGER)) AS negated, round(l_discount, 4) AS rounded FROM lineitem")
def rule_arithmetic(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", (F.col("l_quantity") * 0.1).cast("int").alias("points"), N.negated(F.col("l_linenumber")).alias("negated"), F.round("l_discount", 4).alias("rounded"))


@query("SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g')) / greatest(length(coalesce(text, '')), 1) AS share FROM documents")
def digit_share(spark, d):
    return _docs(spark, d).select("doc_id", N.digit_share(F.coalesce("text", F.lit(""))).alias("share"))


@query("SELECT doc_id, CAST(len(w) AS INTEGER) AS words, array_to_string(w[1:5], ' ') AS first_words, CAST(len(list_distinct(w)) AS INTEGER) AS different, list_contains(w, 'the') AS has_the FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents)")
def array_functions(spark, d):
    w = _docs(spark, d).select("doc_id", F.split(F.coalesce("text", F.lit("")), " ").alias("w"))
    return w.select("doc_id", F.size("w").alias("words"), F.array_join(F.slice("w", 1, 5), " ").alias("first_words"), F.size(F.array_distinct("w")).alias("different"), F.array_contains("w", "the").alias("has_the"))


@query("SELECT event_id, CAST(coalesce(json_extract_string(props, '$.k'), '0') AS INTEGER) + 1 AS merged FROM events")
def map_functions(spark, d):
    m = F.map_concat(F.create_map(F.lit("one"), F.lit(1)), F.create_map(F.lit("k"), F.coalesce(F.from_json("props", "map<string,int>")["k"], F.lit(0))))
    return table(spark, d, "events").select("event_id", (m["one"] + m["k"]).alias("merged"))


@query(f"WITH {_LINES}, f AS (SELECT doc_id, line_no, line, length(line) <= 6 AS s FROM l), g AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - row_number() OVER (PARTITION BY doc_id, s ORDER BY line_no) AS g FROM f), p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s, g ORDER BY line_no) AS k FROM g) SELECT doc_id, min(line_no) AS line_no, string_agg(line, '' ORDER BY line_no) AS line FROM p GROUP BY doc_id, s, g, CASE WHEN s THEN (k - 1) // 12 ELSE k END")
def short_lines_merged(spark, d):
    return latest.merged_short_lines(_lines(spark, d), ["doc_id"], "line_no", "line")


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(array_to_string(list_transform(list_filter(string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)), lambda s: NOT regexp_full_match(trim(s), '[0-9]{1,4}(\\s*/\\s*[0-9]{1,4})?')), lambda s: trim(s)), chr(10)), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')) AS clean FROM documents")
def letter_lines(spark, d):
    return _docs(spark, d).select("doc_id", X.letter_text(F.col("text")).alias("clean"))


# A place to break stands after each 20 characters of a run that 5 or more follow: set after every 20, taken back where fewer follow.
_READING = "SELECT doc_id, array_to_string(list_transform(list_filter(string_split(replace(coalesce(text, ''), chr(13), ''), chr(10)), lambda s: trim(s) <> '' AND NOT regexp_full_match(trim(s), '[0-9]+') AND NOT (regexp_full_match(trim(s), '[0-9]+\\s*/\\s*[0-9]+') AND length(trim(s)) <= 15)), lambda s: regexp_replace(regexp_replace(trim(s), '([!-~]{20})', '\\1' || chr(8203), 'g'), '([!-~]{20})\\x{200b}([!-~]{0,4})([^!-~]|$)', '\\1\\2\\3', 'g')), chr(10)) AS clean FROM documents"


@query(_READING)
def reading_lines(spark, d):
    return _docs(spark, d).select("doc_id", X.reading_text(F.col("text")).alias("clean"))


@query(_READING)
def reading_lines_whole(spark, d):
    return reading_lines(spark, d)


@query("SELECT doc_id, array_to_string(list_transform(list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: trim(s) <> ''), lambda s: '<p>' || replace(replace(replace(replace(replace(trim(s), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;') || '</p>'), chr(10)) AS xhtml FROM documents")
def xhtml_paragraphs(spark, d):
    return _docs(spark, d).select("doc_id", X.paragraphs_xhtml(F.col("text")).alias("xhtml"))


@query("SELECT doc_id, contains(text, 'z') AND contains(text, 'q') AND contains(text, '.') AS has_all FROM documents WHERE text IS NOT NULL")
def characters_present(spark, d):
    return _docs(spark, d).where("text IS NOT NULL").select("doc_id", X.has_all_characters(F.col("text"), F.lit("zq.")).alias("has_all"))


_TITLES = "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '第三节 ' WHEN 1 THEN '二、' WHEN 2 THEN '（一）' WHEN 3 THEN '3、' ELSE '' END || p_name AS t, CAST(p_size AS DOUBLE) AS font FROM part"


@query(f"WITH t AS ({_TITLES}) SELECT p_partkey, CAST(CASE WHEN p_partkey % 5 < 4 THEN p_partkey % 5 + 1 END AS INTEGER) AS level, 0.5 + CASE WHEN font >= 13 THEN 0.2 ELSE 0.0 END + CASE WHEN length(t) <= 30 THEN 0.1 ELSE 0.0 END + 0.1::DOUBLE AS score, CASE p_partkey % 5 WHEN 0 THEN '第三节' WHEN 1 THEN '二' WHEN 2 THEN '（一）' WHEN 3 THEN '3' END AS number FROM t")
def heading_levels(spark, d):
    n = F.col("p_partkey") % 5
    t = F.concat(F.when(n == 0, "第三节 ").when(n == 1, "二、").when(n == 2, "（一）").when(n == 3, "3、").otherwise(""), F.col("p_name"))
    p = table(spark, d, "part").select("p_partkey", t.alias("t"), F.col("p_size").cast("double").alias("font"))
    return p.select("p_partkey", tree.level_of(F.col("t")).alias("level"), tree.heading_score(F.col("font"), F.col("t"), F.lit(1)).alias("score"), tree.title_number(F.col("t")).alias("number"))


@query(f"WITH {_PARENT}, s AS (SELECT conv_id, idx, parent_idx, row_number() OVER (ORDER BY conv_id, idx) AS id FROM p) SELECT s.conv_id, s.idx, s.id, u.id AS parent_id FROM s LEFT JOIN s u ON u.conv_id = s.conv_id AND u.idx = s.parent_idx")
def heading_ids(spark, d):
    h = tree.with_parents(_headings(spark, d), "conv_id")
    return tree.with_ids(h, 1, "conv_id").select("conv_id", "idx", "id", "parent_id")


_STAMP = "(1600000000 + o_orderkey * 3600)"


@query(f"SELECT o_orderkey, CAST(2018 + o_custkey % 6 AS INTEGER) AS year FROM orders WHERE o_custkey % 7 <> 0 AND 2018 + o_custkey % 6 >= 2020 AND {_STAMP} BETWEEN epoch(TIMESTAMP '2020-09-20') AND epoch(TIMESTAMP '2020-11-01') AND left(lpad(CAST(o_custkey AS VARCHAR), 6, '0'), 3) NOT IN ('200', '201', '900')")
def candidate_filter(spark, d):
    stamp = F.lit(1600000000) + F.col("o_orderkey") * 3600
    title = F.concat(F.lit("甲"), (2018 + F.col("o_custkey") % 6).cast("string"), F.lit("年年度报告"))
    raw = _orders(spark, d).select("o_orderkey", title.alias("title"), K.normal_code(F.col("o_custkey").cast("string")).alias("stock_code"), F.when(F.col("o_custkey") % 7 != 0, "甲").alias("stock_name"), F.when(F.col("o_orderkey") % 2 == 0, stamp * 1000).otherwise(stamp).cast("double").alias("ts"))
    out = readers.candidates(raw, F.lit(datetime(2020, 9, 20)), F.lit(datetime(2020, 11, 1)), 2020)
    return out.select("o_orderkey", "year")


@query("SELECT event_id, strftime(ts, '%Y-%m') <> strftime(ts + INTERVAL 10 DAY, '%Y-%m') AS crosses, date_trunc('second', ts) AS whole, CAST(year(ts) - 2 AS INTEGER) AS least FROM events")
def period_functions(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", T.crosses(F.col("ts"), F.col("ts") + F.expr("INTERVAL 10 DAYS"), "month").alias("crosses"), T.whole_seconds(F.col("ts")).alias("whole"), T.least_year(F.col("ts"), 3).alias("least"))


@query(f"WITH {_H} SELECT conv_id, count(*) AS headings, max(page) AS last_page FROM h GROUP BY 1")
def bucket_sizes(spark, d):
    return _headings(spark, d).groupBy("conv_id").agg(F.count(F.lit(1)).alias("headings"), F.max("page").alias("last_page"))
