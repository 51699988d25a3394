"""Spelling variants: frequent words whose forms differ by one letter from a much more frequent word.

Runs are maximal runs of A-Z, a-z and U+00C0..U+00FF, of which A-Z are lower-cased. If 199 divides h, the crc32 of `<doc_id>:<run>`, the
run loses its code point h modulo its length (a fixed rule that plants misspellings). Words are the distinct results of at
least 6 code points that occur at least 5 times. Two words are near if one inserted, deleted or replaced code point
makes one of the other. A word's form is its near word of largest n, the smallest of them on ties, if that n is at least 5 times its own.
Its root is where forms lead in the end.

Plan: words are counted with partial sums. For replacements each word stands in one group for each of its places, named by the word
with the place blanked out, which is position, prefix and suffix at once. All words of a group are near each other, so a group has no more
words than there are letters (90), and its size and its two first words by n are all that a member needs to know. For insertions and
deletions each word's forms with one code point less are looked up in the vocabulary. What groups and lookups say of a word is
summed by word: pairs of a group are never made. Forms are followed by doubling steps; n grows at least fivefold with
each step, so the largest n bounds their number.

Defined results: null and empty texts have no words; a null id counts as an empty string in h; repeated rows count as often as they
stand there; ties go to the smaller word in code-point order; no word gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.llm._shared import ascii_lower, kept, pick

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: What stands in a group's name for the place that differs: no letter.
BLANK = "*"
#: One run in so many loses a code point.
PLANT = 199


def _less(word: Column, at: Column) -> Column:
    """word without its code point at (from 0)."""
    return F.concat(F.substring(word, 1, at), F.substring(word, at + 2, F.length(word)))


def vocabulary(docs: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT, plant: int = PLANT) -> DataFrame:
    """word, n: the words of at least so many code points and occurrences."""
    own = pick(docs, "doc_id", "text")
    # a shorter run makes no word
    runs = own.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{length},}}"), F.lit(0))).alias("run"))
    low = runs.select("id", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    word = F.when(h % plant == 0, _less(F.col("run"), (h % F.length("run")).cast("int"))).otherwise(F.col("run"))
    words = low.select(word.alias("word")).where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def _first(n: Column, word: Column) -> Column:
    """Least for the largest n and, of these, the smallest word."""
    return F.struct((-n).alias("minus"), word.alias("word"))


def replaced(words: DataFrame) -> DataFrame:
    """word, count, best: for each group of a word with others in it, how many they are and the first of them."""
    places = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("p"))
    named = places.select("word", "n", F.concat(F.substring(F.col("word"), 1, F.col("p")), F.lit(BLANK), F.substring(F.col("word"), F.col("p") + 2, F.length("word"))).alias("g"))
    order = Window.partitionBy("g").orderBy(F.desc("n"), "word")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = _first(F.col("n"), F.col("word"))
    ranked = named.select("word", F.row_number().over(order).alias("k"), F.count("*").over(whole).alias("size"), F.first(me).over(whole).alias("top"), F.nth_value(me, 2).over(whole).alias("second"))
    return ranked.where(F.col("size") > 1).select("word", (F.col("size") - 1).alias("count"), F.when(F.col("k") == 1, F.col("second")).otherwise(F.col("top")).alias("best"))


def shortened(words: DataFrame) -> DataFrame:
    """word, count, best: a row for the longer and one for the shorter word of each deletion that is a word."""
    less = F.transform(F.sequence(F.lit(0), F.length("word") - 1), lambda p: _less(F.col("word"), p))
    cut = words.select(F.col("word").alias("long"), F.col("n").alias("long_n"), F.explode(F.array_distinct(less)).alias("word"))
    met = cut.join(words, "word")
    both = F.array(F.struct(F.col("word"), _first(F.col("long_n"), F.col("long")).alias("best")), F.struct(F.col("long").alias("word"), _first(F.col("n"), F.col("word")).alias("best")))
    return met.select(F.explode(both).alias("x")).select("x.word", F.lit(1).cast("long").alias("count"), "x.best")


def _roots(forms: DataFrame, most: int, ratio: int, spark: SparkSession) -> DataFrame:
    """word, root for (word, at): at is the word's form."""
    steps, reach = 1, LEAST_COUNT * ratio
    while reach * ratio <= most:  # the longest chain of forms that counts up to ``most`` allow
        steps, reach = steps + 1, reach * ratio
    done = 1
    while done < steps:
        onward = forms.select(F.col("word").alias("at"), F.col("at").alias("next"))
        forms = kept(forms.join(onward, "at", "left").select("word", F.coalesce("next", "at").alias("at")), spark, "spelling-roots")
        done *= 2
    return forms.select("word", F.col("at").alias("root"))


def variants(words: DataFrame, spark: SparkSession | None = None, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for (word, n): a row for each word."""
    spark = spark or words.sparkSession
    words = kept(words, spark, "spelling-words")
    said = replaced(words).unionByName(shortened(words)).groupBy("word").agg(F.sum("count").alias("n_near"), F.min("best").alias("best"))
    has = -F.col("best.minus") >= ratio * F.col("n")
    judged = words.join(said, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.minus")).alias("form_n"))
    judged = kept(judged, spark, "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(judged.where(F.col("form").isNotNull()).select("word", F.col("form").alias("at")), most, ratio, spark)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    return variants(vocabulary(docs), spark)


def _crc_table() -> list[int]:
    """What crc32 adds for each byte, from its polynomial."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


SQL = rf"""
WITH RECURSIVE e AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
o AS (SELECT id, run, count(*) AS k, hex(encode(id || ':' || run)) AS x FROM e WHERE length(run) >= 6 GROUP BY id, run),
h AS (SELECT run, k, xor(4294967295, list_reduce(list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)), lambda a, b: xor(a >> 8, {_crc_table()}[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h FROM o),
m AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM m WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
p AS (SELECT word, n, substr(word, 1, i) || '*' || substr(word, i + 2) AS g, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
d AS (SELECT DISTINCT p.word AS a, v.word AS b, p.n AS na, v.n AS nb FROM p JOIN v ON p.d = v.word),
near AS (SELECT x.word AS a, y.word AS b, y.n AS nb FROM p x JOIN p y ON x.g = y.g AND x.word <> y.word UNION ALL SELECT a, b, nb FROM d UNION ALL SELECT b, a, na FROM d),
best AS (SELECT a AS word, count(*) AS n_near, arg_min({{'b': b, 'n': nb}}, {{'m': -nb, 'w': encode(b)}}) AS best FROM near GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 5 * v.n THEN best.b END AS form, CASE WHEN best.n >= 5 * v.n THEN best.n END AS form_n FROM v LEFT JOIN best USING (word)),
r AS (SELECT word, word AS cur, 0 AS step FROM f UNION ALL SELECT r.word, f.form, step + 1 FROM r JOIN f ON r.cur = f.word WHERE f.form IS NOT NULL),
z AS (SELECT word, arg_max(cur, step) AS root FROM r GROUP BY word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM f JOIN z USING (word)"""
