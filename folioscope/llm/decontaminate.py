"""Benchmark decontamination: exact 13-gram overlap between documents and benchmark items.

Words are maximal runs of characters other than U+0000..U+002F, U+003A..U+0060 and U+007B..U+007F
after A-Z became a-z. A window is 13 consecutive words of an item; an item with fewer words, but
not none, is one window. A document word inside any occurrence of a window is hit.

Plan: every window contains a gram of GRAM words that starts at a multiple of 7 in its item (shorter
whole items are such grams themselves). The hashes of those grams are a
set of proven size: counted first, put into the plan as a hash set up to MAX_SET, joined to the
exploded grams beyond that (Spark then picks broadcast or shuffle by size). One scan of the
documents finds the places whose gram is in the set. The windows around each of the few places, as strings of their words, are
joined to the items' windows, so nothing rests on hashes and words that many items and documents share
short of a window make no rows. Windows that many documents have meet one row for each; ids of items are joined to distinct windows.

Defined results: null, empty or wordless texts have no words and no hits; wordless items have no
windows; items of the same id count once; repeated documents get equal rows; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm._shared import ascii_lower, kept, let, pick

N, GRAM = 13, 7
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Hashes that may stand in the plan. Beyond that they are a table that is joined.
MAX_SET = 20_000
#: Windows of items that may be broadcast; more are shuffled.
MAX_BROADCAST = 200_000
#: One document word in so many must be hit for the document to count as contaminated.
SHARE = 20


def words_of(low: Column) -> Column:
    """The words of a lower-cased text (null: none)."""

    def trimmed(ws: Column) -> Column:
        first = F.when(F.element_at(ws, 1) == "", 2).otherwise(1)
        last = F.size(ws) - F.when(F.element_at(ws, -1) == "", 1).otherwise(0)
        return F.slice(ws, first, F.greatest(last - first + 1, F.lit(0)))

    return let(F.split(F.coalesce(low, F.lit("")), GAP, -1), trimmed)


def _gram(ws: Column, p: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(ws, p + i) for i in range(k)])


def _among(ws: Column, k: int, grams: list[int]):
    return lambda p: _gram(ws, p, k).isin(grams)


def _with_gram(words: str, k: int):
    return lambda p: F.struct(p.alias("p"), _gram(F.col(words), p, k).alias("g"))


def _rough(text: Column) -> Column:
    """Lower case for the search: a fast form, but for a letter whose lower case depends on its neighbours."""
    return F.when(F.contains(text, F.lit("Σ")), ascii_lower(text)).otherwise(F.lower(text))


def items_of(bench: DataFrame) -> DataFrame:
    """item, item_id, words: the benchmark's items that have words."""
    own = pick(bench, "item_id", "text").distinct()
    rows = own.select("item_id", words_of(ascii_lower(F.col("text"))).alias("words")).where(F.size("words") > 0)
    return rows.withColumn("item", F.monotonically_increasing_id())


def _anchors(items: DataFrame, k: int) -> DataFrame:
    """item, at, exact and rough hash of the grams of k words that stand for the item's windows."""
    n = F.size("words")
    if k == GRAM:
        some = items.where(n >= GRAM)
        step = N - GRAM + 1
        at = F.sequence(F.lit(0), F.when(n <= N, F.lit(0)).otherwise(n - GRAM), F.lit(step))
    else:
        some, at = items.where(n == k), F.array(F.lit(0))
    rows = some.select("item", "words", F.explode(at).alias("at"))
    low = F.transform("words", lambda w: F.lower(w))
    return rows.select("item", "at", _gram(F.col("words"), F.col("at"), k).alias("exact"), let(low, lambda ws: _gram(ws, F.col("at"), k)).alias("rough"))


def _window(words: str, start: Column, n: Column) -> Column:
    """Words have no spaces, so equal strings are equal windows."""
    return F.array_join(F.slice(words, start + 1, n), " ")


def _around(at: str, words: str, widths: list[int]) -> Column:
    """array<struct<s, w>>: windows of words of these widths that have a gram at one of the places: short ones begin with it.

    Places are in ascending order; a long window comes from the first place that it covers, so each comes once.
    """
    n = F.size(words)

    def near(p: Column, i: Column) -> Column:
        short = [F.when(p + w <= n, F.array(F.struct(p.alias("s"), F.lit(w).alias("w")))) for w in widths if w < N]
        first = F.greatest(p - (N - GRAM), F.coalesce(F.get(F.col(at), i - 1) + 1, F.lit(0)), F.lit(0))
        last = F.least(p, n - N)
        long = [F.when(first <= last, F.transform(F.sequence(first, F.greatest(first, last)), lambda s: F.struct(s.alias("s"), F.lit(N).alias("w"))))] if N in widths else []
        return F.concat(*[F.coalesce(x, F.array().cast("array<struct<s:int,w:int>>")) for x in (*short, *long)])

    return F.flatten(F.transform(at, near))


def hits(docs: DataFrame, bench: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Per document: row, doc_id, n_words, hit (places of hit words, from 0, ascending), items (ids, sorted as strings)."""
    spark = spark or docs.sparkSession
    items = kept(items_of(bench), spark, "bench-items")
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(GRAM)).alias("k")).distinct().collect())  # 1 to GRAM
    anchors = None
    for k in lengths:
        a = _anchors(items, k).withColumn("k", F.lit(k))
        anchors = a if anchors is None else anchors.union(a)
    base = pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    if anchors is None:
        none = base.select("row", "doc_id", words_of(F.col("text")).alias("w"))
        return none.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.array().cast("array<int>").alias("hit"), F.array().cast("array<string>").alias("items"))
    anchors = kept(anchors, spark, "bench-grams")
    either = anchors.select(F.explode(F.array("exact", "rough")).alias("g"), "k").distinct()
    in_plan = either.count() <= MAX_SET
    sets = {k: [r[0] for r in either.where(F.col("k") == k).select("g").collect()] for k in lengths} if in_plan else {}

    def found(ws: Column) -> Column:
        n = F.size(ws)
        places = []
        for k in lengths:
            if in_plan:
                places.append(F.when(n >= k, F.filter(F.sequence(F.lit(0), n - k), _among(ws, k, sets[k]))).otherwise(F.array().cast("array<int>")))
        at = F.sort_array(F.array_distinct(F.concat(*places))) if in_plan else F.array().cast("array<int>")
        return F.struct(n.alias("n"), at.alias("at"))

    scan = base.select("row", "doc_id", "text", let(words_of(_rough(F.col("text"))), found).alias("f"))
    if in_plan:
        scan = scan.select("row", "doc_id", F.col("f.n").alias("n"), F.col("f.at").alias("at"), F.when(F.size("f.at") > 0, F.col("text")).alias("text"))
    else:
        grams = base.select("row", words_of(_rough(F.col("text"))).alias("w"))
        each = None
        for k in lengths:
            e = grams.where(F.size("w") >= k).select("row", F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - k), _with_gram("w", k))).alias("x")).select("row", "x.p", "x.g")
            each = e if each is None else each.union(e)
        at = each.join(either, "g", "left_semi").groupBy("row").agg(F.sort_array(F.collect_set("p")).alias("at"))
        scan = scan.join(at, "row", "left").select("row", "doc_id", F.col("f.n").alias("n"), F.coalesce("at", F.array().cast("array<int>")).alias("at"), F.when(F.col("at").isNotNull(), F.col("text")).alias("text"))
    scan = kept(scan, spark, "bench-scan")

    texts = scan.where(F.size("at") > 0).select("row", "at", words_of(ascii_lower(F.col("text"))).alias("ws"))
    widths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(N)).alias("w")).distinct().collect())  # 1 to N
    windows = texts.select("row", "ws", F.explode(_around("at", "ws", widths)).alias("x")).select("row", "x.s", "x.w", _window("ws", F.col("x.s"), F.col("x.w")).alias("g"))
    own = items.withColumn("w", F.least(F.size("words"), F.lit(N)))
    own = own.select("item_id", "words", "w", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("w"))).alias("s"))
    own = kept(own.select("item_id", _window("words", F.col("s"), F.col("w")).alias("g")).distinct(), spark, "bench-windows")
    known = own.select("g").distinct()
    if known.count() <= MAX_BROADCAST:
        known = F.broadcast(known)
    met = kept(windows.join(known, "g", "left_semi"), spark, "bench-met")
    hit = met.groupBy("row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("s"), F.col("s") + F.col("w") - 1))))).alias("hit"))
    named = met.select("row", "g").distinct().join(own, "g").select("row", F.col("item_id").cast("string").alias("item")).distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    per = hit.join(named, "row")
    return scan.select("row", "doc_id", F.col("n").cast("long").alias("n_words")).join(per, "row", "left").select("row", "doc_id", "n_words", F.coalesce("hit", F.array().cast("array<int>")).alias("hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(docs: DataFrame, bench: DataFrame, spark: SparkSession | None = None, share: int = SHARE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: a row for each document."""
    h = hits(docs, bench, spark)
    n = F.size("hit").cast("long")
    return h.select("doc_id", "n_words", n.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), ((n > 0) & (share * n >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, bench: DataFrame, spark: SparkSession | None = None, share: int = SHARE, spans: bool = False) -> DataFrame:
    """docs without contaminated documents; with spans, all documents, but hit words blanked out of contaminated ones.

    spans: the text becomes the remaining words of the document, lower-cased, with a space between.
    """
    spark = spark or docs.sparkSession
    cols = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    text, doc_id = F.col(f"c{cols.index('text')}"), F.col(f"c{cols.index('doc_id')}")
    # by text, not by id alone: rows of the same id may have different texts
    h = hits(rows.select(F.struct(doc_id.alias("k"), F.xxhash64(text).alias("x")).alias("doc_id"), text.alias("text")), bench, spark)
    n = F.size("hit")
    bad = kept(h.where((n > 0) & (share * n >= F.col("n_words"))).select("doc_id.*", "hit").dropDuplicates(["k", "x"]), spark, "bench-bad")
    same = doc_id.eqNullSafe(F.col("k")) & (F.xxhash64(text) == F.col("x"))
    if not spans:
        names = bad.select("k", "x")
        return rows.join(F.broadcast(names) if names.count() <= MAX_BROADCAST else names, same, "left_anti").toDF(*cols)
    got = rows.join(bad, same, "left")
    # hit documents have words; array_except hashes, so dense hits cost no more than the text
    left = let(words_of(ascii_lower(text)), lambda ws: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ws) - 1), F.col("hit")), lambda i: F.get(ws, i)), " "))
    fixed = F.when(F.col("hit").isNull(), text).otherwise(left)
    return got.select(*[fixed.alias(f"c{i}") if c == "text" else F.col(f"c{i}") for i, c in enumerate(cols)]).toDF(*cols)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT item_id, ws, least(13, len(ws)) AS w FROM b WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, w, array_to_string(ws[s:s + w - 1], ' ') AS g FROM (SELECT item_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS s FROM i)),
k AS (SELECT DISTINCT w FROM iw),
dw AS (SELECT row, w, s, array_to_string(ws[s:s + w - 1], ' ') AS g FROM (SELECT row, ws, w, unnest(range(1, len(ws) - w + 2)) AS s FROM d, k)),
m AS (SELECT row, item_id, s, dw.w FROM dw JOIN iw ON dw.w = iw.w AND dw.g = iw.g),
h AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(s, s + w)) AS p FROM m) GROUP BY row),
t AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (row) LEFT JOIN t USING (row)"""
