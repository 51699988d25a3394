"""Queries of the chapter locator, the heading detector and letters, over pages and lines made of the documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioscope.operators import chapters as C
from folioscope.operators import headings as H
from folioscope.operators import tree
from folioscope.plans.catalog import query
from folioscope.sources import sinks
from folioscope.session import table

#: Each line of a document is a page; so many places of 29 get one of these after it.
_MARKS = (
    "第三节 管理层讨论与分析", "详见第三节“管理层讨论与分析”", "目 录", "一 ........ 3\n二 ........ 9\n三 ........ 12", "一、报告期内公司从事的主要业务情况", "第四节 公司治理",
    "分季度主要财务指标", "三、报告期内核心竞争力分析", "主要业务", "；十二、报告期内接待调研", "经营情况讨论和分析", "本公司第三节 管理层讨论与分析的说明", "风险提示：管理层讨论与分析",
    "第一节 第二节 第三节 第四章 第五章 第六章 第七部分 第8节", "（二）主营业务分析", "请查阅第三节 管理层讨论和分析",
    "管理层讨论与分析\n非经常性损益", "报告期内公司从事的主要业务",
)
_LIST = "[" + ", ".join("'" + m.replace("\n", "' || chr(10) || '") + "'" for m in _MARKS) + "]"
_R = lambda p: "'" + p.replace("'", "''") + "'"
_DENSE = r"regexp_replace({}, '[\s\p{{Z}}]+', '', 'g')"
_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_PAGES = f"""pg AS (SELECT doc_id, i - 1 AS page, ls[i] || coalesce(chr(10) || {_LIST}[(doc_id * 7 + i * 11) % 29 + 1], '') AS t FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)))"""
_WITHIN = f"regexp_extract(t, {_R('[^' + chr(92) + 'n]*' + C.TITLE_WITHIN + '[^' + chr(92) + 'n]*')})"
_AROUND = f"regexp_extract(t, {_R('(?s).{0,30}' + C.TITLE_WITHIN + '.{0,30}')})"
_FLAGS = f"""fl AS (SELECT doc_id, page, t,
regexp_matches(t, {_R(C.LISTS)}) OR len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, {_R(C.LEADER)}))) >= 3 OR len(regexp_extract_all(t, {_R(C.ITEM)})) >= 8 AS list,
NOT (regexp_matches({_DENSE.format('t')}, {_R(C.NAMES_IT)}) AND regexp_matches({_DENSE.format('t')}, {_R(C.POINTS + '|' + C.CAUTIONS)})) AND (len(list_filter(string_split(t, chr(10)), lambda l: regexp_matches({_DENSE.format('l')}, {_R(C.TITLE_LINE)}))) > 0 OR ({_WITHIN} <> '' AND NOT regexp_matches({_WITHIN}, {_R(C.QUOTES)}) AND length({_DENSE.format(_WITHIN)}) <= 60 AND NOT regexp_matches({_DENSE.format(_AROUND)}, {_R(C.POINTS)}))) AS title,
regexp_matches(t, {_R(C.ANCHOR)}) AS anchor, regexp_matches(t, {_R(C.NEAR_ANCHOR)}) AS near, regexp_matches(t, {_R(C.FIGURES)}) AS figures, regexp_matches(t, {_R(C.LATER)}) AS later
FROM pg WHERE {_DENSE.format('t')} <> ''),
st AS (SELECT doc_id, min(page) FILTER (title AND NOT list AND page BETWEEN 6 AND 159) AS h, min(page) FILTER (anchor AND NOT list AND page BETWEEN 6 AND 179) AS a FROM fl GROUP BY doc_id),
s AS (SELECT doc_id, coalesce(h, a) AS s, CASE WHEN h IS NULL THEN 'anchor' ELSE 'title' END AS how FROM st WHERE coalesce(h, a) IS NOT NULL),
f AS (SELECT doc_id, how, coalesce(min(page) FILTER ((title OR near) AND NOT list AND NOT figures AND page BETWEEN s AND s + 11), min(s)) AS first_page FROM s JOIN fl USING (doc_id) GROUP BY doc_id, how),
e AS (SELECT doc_id, how, first_page, coalesce(min(page) FILTER (later AND page >= first_page AND page < first_page + 160), first_page + 160) AS end_page FROM f JOIN fl USING (doc_id) GROUP BY doc_id, how, first_page)"""
_BEGIN = ", ".join(f"nullif(regexp_extract(t, {_R('(?s)(?:' + p + ').*')}), '')" for p in C.BEGINS)
_CUT = lambda p: f"regexp_extract(full_mda, {_R('(?s)^(.*?)(?:' + p + ')')}, 1)"


def _pages(spark, d):
    doc = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("page", "line"))
    at = ((F.col("doc_id") * 7 + (F.col("page") + 1) * 11) % 29).cast("int")
    mark = F.get(F.array(*[F.lit(m) for m in _MARKS]), at)
    return doc.select("doc_id", "page", F.concat("line", F.coalesce(F.concat(F.lit("\n"), mark), F.lit(""))).alias("text"))


@query(f"WITH {_PAGES}, {_FLAGS} SELECT doc_id, CAST(page AS INTEGER) AS page, how, CAST(first_page AS INTEGER) AS first_page, CAST(end_page AS INTEGER) AS end_page FROM e JOIN fl USING (doc_id) WHERE page >= first_page AND page < end_page")
def chapter_pages(spark, d):
    return C.located(_pages(spark, d), "doc_id").select("doc_id", "page", "how", "first_page", "end_page")


@query(
    f"WITH {_PAGES}, {_FLAGS}, c AS (SELECT doc_id, how, first_page, count(*) AS n_pages, string_agg(t, chr(10) ORDER BY page) AS t FROM e JOIN fl USING (doc_id) WHERE page >= first_page AND page < end_page GROUP BY doc_id, how, first_page), "
    f"m AS (SELECT doc_id, how, first_page, n_pages, {_STRIP.format(f'coalesce({_BEGIN}, t)')} AS full_mda FROM c), o AS (SELECT *, CASE WHEN regexp_matches(full_mda, {_R(C.CORE_LINE)}) THEN {_CUT(C.CORE_LINE)} WHEN regexp_matches(full_mda, {_R(C.STOP_LINE)}) THEN {_CUT(C.STOP_LINE)} ELSE full_mda END AS cut FROM m) "
    f"SELECT doc_id, how, CAST(first_page AS INTEGER) AS first_page, n_pages, full_mda, CASE WHEN length({_STRIP.format('cut')}) < 500 THEN full_mda ELSE {_STRIP.format('cut')} END AS business FROM o"
)
def chapter_texts(spark, d):
    return C.chapters(_pages(spark, d), "doc_id")


# A letter made of the text: lines that look like a table of contents are dropped, and it is long enough or not.
_KEPT = r"list_filter(string_split('致股东' || chr(10) || coalesce(text, ''), chr(10)), lambda l: NOT (regexp_matches(trim(l), '[.·…]{4,}\s*[0-9]{1,4}\s*$') OR (length(trim(l)) <= 30 AND regexp_matches(trim(l), '\s[0-9]{1,4}\s*$') AND NOT regexp_matches(trim(l), '(?:19|20)[0-9]{2}\s*$'))))"


@query(rf"WITH t AS (SELECT doc_id, regexp_replace(array_to_string({_KEPT}, chr(10)), '\s+$', '') AS t FROM documents), l AS (SELECT doc_id, t, length({_DENSE.format('t')}) >= 400 AND (length(t) - length(replace(t, chr(10), '')) >= 2 OR length(t) >= 900) AS ok FROM t) SELECT doc_id, CASE WHEN ok AND length(t) > 50000 THEN regexp_replace(left(t, 46000), '\s+$', '') || chr(10) || chr(10) || '[...TRUNCATED...]' || chr(10) || chr(10) || regexp_replace(right(t, 12000), '^\s+', '') WHEN ok THEN t END AS letter FROM l")
def shareholder_letters(spark, d):
    text = F.concat(F.lit("封面\n致股东\n"), F.coalesce("text", F.lit("")), F.lit("\n第一节 重要提示\n"), F.coalesce("source", F.lit("")))
    return table(spark, d, "documents").select("doc_id", C.letter_of(text).alias("letter"))


#: Sentences are lines, numbered in seven ways or not at all; parts between commas are spans; each fifth document has an outline, of blank titles for some.
_NUMBERED = ("第三节 ", "二、", "（一）", "3、", "1.2 ", "4.", "")
_NUMBERS = "[" + ", ".join(f"'{n}'" for n in _NUMBERED) + "]"
_LINES_SQL = rf"sp AS (SELECT doc_id, (i - 1) // 5 + 1 AS page, i AS line, string_split({_NUMBERS}[(doc_id + i) % 7 + 1] || ls[i], ', ') AS parts, 8 + length(ls[i]) % 9 AS size FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split_regex(coalesce(text, ''), '[.\n]') AS ls FROM documents)))"
_OUTLINE_SQL = r"ol AS (SELECT doc_id, place, CAST(1 + place AS INTEGER) AS level, regexp_replace(CASE WHEN doc_id % 10 = 0 THEN ' ' ELSE ' 第' || (1 + place) || '节 ' || source END, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS title, greatest(CAST(doc_id % 3 AS INTEGER), 1) AS page FROM documents, range(2) r(place) WHERE doc_id % 5 = 0)"
_HEADINGS_SQL = f"""{_LINES_SQL}, {_OUTLINE_SQL}, o AS (SELECT doc_id, page, 0 AS line_no, title, level, 1.0::DOUBLE AS score, 'toc' AS method, place FROM ol WHERE title <> ''),
ln AS (SELECT doc_id, page, row_number() OVER (PARTITION BY doc_id, page ORDER BY line) AS line_no, {_STRIP.format("array_to_string(parts, '')")} AS title, size, len(parts) AS n FROM sp WHERE doc_id NOT IN (SELECT doc_id FROM o)),
d AS (SELECT doc_id, page, line_no, title, CASE WHEN regexp_matches(title, '^第[0-9一二三四五六七八九十百零〇]+节') THEN 1 WHEN regexp_matches(title, '^[一二三四五六七八九十]+[、.]') THEN 2 WHEN regexp_matches(title, '^（[一二三四五六七八九十]+）') OR regexp_matches(title, '^[0-9]+[、.]') THEN 3 ELSE 2 END AS level, round(0.5 + CASE WHEN size >= 13 THEN 0.2 ELSE 0 END + CASE WHEN length(title) <= 30 THEN 0.1 ELSE 0 END + CASE WHEN n = 1 THEN 0.1 ELSE 0 END, 4)::DOUBLE AS score, 'text_heading' AS method, 0 AS place FROM ln
WHERE title <> '' AND length(title) <= 60 AND regexp_matches(title, '^(第[0-9一二三四五六七八九十百零〇]+节[ 　]+|[一二三四五六七八九十]+[、.]|[(（][一二三四五六七八九十]+[)）]|[0-9]+[、.])')),
h AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, line_no, level, place, title) - 1 AS idx FROM (SELECT * FROM o UNION ALL SELECT * FROM d))"""


def _outline_and_spans(spark, d):
    doc = table(spark, d, "documents")
    each = doc.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"[.\n]", -1)).alias("i", "line"))
    text = F.concat(F.get(F.array(*[F.lit(n) for n in _NUMBERED]), ((F.col("doc_id") + F.col("i") + 1) % 7).cast("int")), "line")
    rows = each.select("doc_id", F.floor(F.col("i") / 5).cast("int").alias("i5"), F.col("i").alias("line"), F.posexplode(F.split(text, ", ", -1)).alias("span", "text"), (8 + F.length("line") % 9).cast("double").alias("size"))
    spans = rows.select("doc_id", (F.col("i5") + 1).alias("page"), "line", "span", "text", "size")
    fifth = doc.where(F.col("doc_id") % 5 == 0).select("doc_id", "source", F.explode(F.array(F.lit(0), F.lit(1))).alias("place"))
    title = F.when(F.col("doc_id") % 10 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" 第"), (F.col("place") + 1).cast("string"), F.lit("节 "), "source"))
    return fifth.select("doc_id", "place", (F.col("place") + 1).alias("level"), title.alias("title"), (F.col("doc_id") % 3).cast("int").alias("page")), spans


@query(f"WITH {_HEADINGS_SQL} SELECT doc_id, CAST(idx AS INTEGER) AS idx, CAST(level AS INTEGER) AS level, title, {_DENSE.format('title')} AS plain, nullif(regexp_extract(title, '{H.NUMBER}', 1), '') AS number, CAST(page AS INTEGER) AS page, CAST(line_no AS INTEGER) AS line_no, score, method, CAST((SELECT max(p.idx) FROM h p WHERE p.doc_id = h.doc_id AND p.idx < h.idx AND p.level < h.level) AS INTEGER) AS parent_idx FROM h")
def headings_detected(spark, d):
    return tree.with_parents(H.detected(*_outline_and_spans(spark, d), "doc_id"), "doc_id")


@query("WITH l AS (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)), b AS (SELECT doc_id, i - 1 AS page, length(ls[i]) AS n, (i - 1) // 3 AS batch FROM l), s AS (SELECT doc_id, batch, sum(n) AS n FROM b GROUP BY 1, 2) SELECT doc_id, CAST(page AS INTEGER) AS page, coalesce((SELECT sum(s.n) FROM s WHERE s.doc_id = b.doc_id AND s.batch < b.batch), 0) >= 2000 AS late FROM b")
def pages_in_budget(spark, d):
    doc = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("page", "text"))
    return C.within_budget(doc, "doc_id", 2000, 3).select("doc_id", "page", "late")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '8.31' ELSE month(o_orderdate) || '.' || day(o_orderdate) END AS tab FROM orders")
def daily_snapshot_tabs(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate").cast("date")).alias("publish_date"))
    return sinks.snapshot(rows, F.lit(date(2024, 8, 31))).select("o_orderkey", "tab")
