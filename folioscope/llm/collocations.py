"""Phrase collocation mining: phrases of 2 to 5 words that stand together far more often than their parts would by chance.

Texts become lower case (A-Z only) and are cut into pieces at `.,;:!?` and U+000A..U+000D, pieces into words at spaces and tabs. Everything is
counted by lang: n is the number of all words, f(phrase) that of its occurrences within pieces, overlapping ones included. Candidates are
phrases of 2 to 5 words with a = f(phrase) >= LEAST. A cut after the first k words gives l = f(first part), r = f(rest) and the score
floor(1000 * a * n / (l * r)); the cut with the lowest score counts, the first of equal ones. A candidate whose words lie side by
side in a longer candidate that is as frequent is dropped. The result is each lang's first TOP by score, then a, then phrase.

Plan: equal pieces become one with a multiplicity, so copies are counted once. Phrases are counted by DuckDB in two steps, each over a
stream of rows and out of core: within a task, then, after a shuffle by phrase, within a hash bucket. A phrase can only be frequent if its words, and
the pairs of neighbours in it, are: words are counted first, then pairs of frequent words, then runs of 3 to 5 words all of whose pairs are
frequent. Which words and pairs are frequent is told by a bitmap of BITS hash cells, whatever their number; a wrong yes costs a
row and nothing else. The parts of candidates are looked up by requests that are shuffled to where their counts are. Scores are exact:
products are decimals of 38 digits. Ranks come from ranges of the order, no task sees a lang's candidates together.

Defined results: null texts have no words; a null lang counts as `und`; repeated rows count as often as they stand there; an empty
table gives an empty result. Sums are exact up to 2^63.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm._shared import ascii_lower, kept, pick
from folioscope.operators.latest import running_total

LEAST, LONGEST, TOP = 100, 5, 2000
#: Cells of the bitmap of frequent phrases: 2 MB.
BITS = 1 << 24
#: What DuckDB may use of a task's memory before it writes to the task's temporary folder.
MEMORY = "192MB"
#: Langs whose sums are broadcast; more are joined.
MAX_BROADCAST = 100_000
COUNTS = "lang string, phrase string, n long"

_CELL = f"CAST(hash(lang, {{}}) & {BITS - 1} AS INTEGER)"
_FREQUENT = f"get_bit(getvariable('frequent'), {_CELL}) = 1"
_WORDS = "SELECT lang, n, unnest(string_split(piece, ' ')) AS phrase FROM rows"
_PAIRS = "SELECT lang, n, a || ' ' || b AS phrase FROM (SELECT lang, n, unnest(ws[:-2]) AS a, unnest(ws[2:]) AS b FROM (SELECT lang, n, string_split(piece, ' ') AS ws FROM rows) WHERE len(ws) >= 2) WHERE " + _FREQUENT.format("a") + " AND " + _FREQUENT.format("b")
_LONGER = (
    "SELECT lang, n, unnest([abc, abc || ' ' || d, abc || ' ' || d || ' ' || e]) AS phrase FROM ("
    "SELECT lang, n, a || ' ' || b || ' ' || CASE WHEN lead(i) OVER w = i + 1 THEN lead(b) OVER w END AS abc, CASE WHEN lead(i, 2) OVER w = i + 2 THEN lead(b, 2) OVER w END AS d, CASE WHEN lead(i, 3) OVER w = i + 3 THEN lead(b, 3) OVER w END AS e FROM ("
    "SELECT id, lang, n, unnest(range(len(ws) - 1)) AS i, unnest(ws[:-2]) AS a, unnest(ws[2:]) AS b FROM (SELECT row_number() OVER () AS id, lang, n, string_split(piece, ' ') AS ws FROM rows) WHERE len(ws) >= 3"
    ") WHERE " + _FREQUENT.format("a || ' ' || b") + " WINDOW w AS (PARTITION BY id ORDER BY i))"
)
_SUM = "SELECT lang, phrase, CAST(sum(n) AS BIGINT) AS n FROM ({}) WHERE phrase IS NOT NULL GROUP BY lang, phrase"


def _duckdb(sql: str, bitmap: bytes | None = None):
    """sql over a stream of Arrow batches named rows, within a task."""

    def run(batches: Iterable[pa.RecordBatch]):
        import duckdb

        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        with tempfile.TemporaryDirectory() as scratch, duckdb.connect() as con:
            con.execute(f"SET threads = 1; SET memory_limit = '{MEMORY}'; SET temp_directory = '{scratch}'; SET preserve_insertion_order = false")
            if bitmap is not None:
                con.execute("SET VARIABLE frequent = CAST(CAST(? AS BLOB) AS BIT)", [bitmap])
            con.register("rows", pa.RecordBatchReader.from_batches(first.schema, chain([first], batches)))
            yield from con.sql(sql).to_arrow_reader(20_000)

    return run


def pieces_of(docs: DataFrame) -> DataFrame:
    """lang, piece (its words with one space between), n (how often it stands there)."""
    own = pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), ascii_lower(F.col("text")).alias("text"))
    cut = own.select("lang", F.explode(F.split("text", r"[.,;:!?\x0A-\x0D]", -1)).alias("piece"))
    wide = F.col("piece").rlike("\t|  ")
    cut = cut.select("lang", F.trim(F.when(wide, F.regexp_replace("piece", "[ \t]+", " ")).otherwise(F.col("piece"))).alias("piece"))
    return cut.where(F.col("piece") != "").groupBy("lang", "piece").agg(F.count("*").alias("n"))


def counted(pieces: DataFrame, phrases: str, bitmap: bytes | None, least: int) -> DataFrame:
    """lang, phrase, n >= least of the phrases that the SQL makes of rows (lang, piece, n)."""
    own = pieces.mapInArrow(_duckdb(_SUM.format(phrases), bitmap), COUNTS)
    return own.repartition("lang", "phrase").mapInArrow(_duckdb(_SUM.format("rows") + f" HAVING sum(n) >= {least}"), COUNTS)


def bitmap_of(counts: DataFrame) -> bytes:
    """The bitmap of the phrases' cells."""
    cells = counts.select("lang", "phrase").mapInArrow(_duckdb(f"SELECT DISTINCT CAST({_CELL.format('phrase')} AS BIGINT) + 1 AS cell FROM rows"), "cell long")
    part = cells.groupBy(F.bitmap_bucket_number("cell").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits"))
    bits = np.zeros(BITS, np.uint8)
    for r in part.collect():  # BITS / 32768 rows at most
        at = (r["part"] - 1) * 32768
        bits[at : at + 32768] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    return np.packbits(bits).tobytes()


def _parts(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def _within(words: Column) -> Column:
    """All shorter phrases of at least two words in a row of words."""
    n = F.size(words)
    at = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda s: _parts(words, s, k))
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), n - 1), at)))


def scored(candidates: DataFrame, single: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of candidates (lang, phrase, n) that no longer one contains as often; single: counts of words; totals: lang, total."""
    rows = candidates.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    longer = rows.where(F.size("words") > 2).select("lang", F.explode(_within(F.col("words"))).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    rows = rows.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer") < F.col("a"), F.lit(True)))
    cuts = F.sequence(F.lit(1), F.size("words") - 1)
    asked = rows.select("lang", "phrase", "a", "words", F.explode(cuts).alias("k"))
    sides = F.array(F.struct(F.lit(True).alias("left"), _parts(F.col("words"), F.lit(1), F.col("k")).alias("part")), F.struct(F.lit(False).alias("left"), _parts(F.col("words"), F.col("k") + 1, F.size("words") - F.col("k")).alias("part")))
    asked = asked.select("lang", "phrase", "a", "k", F.explode(sides).alias("x")).select("lang", "phrase", "a", "k", "x.left", "x.part")
    told = single.unionByName(candidates).select("lang", F.col("phrase").alias("part"), "n")
    cut = asked.join(told, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r"))
    totals = F.broadcast(totals) if totals.count() <= MAX_BROADCAST else totals
    cut = cut.join(totals, "lang").withColumn("score", F.expr("cast(1000 as decimal(38,0)) * a * total div (cast(l as decimal(38,0)) * r)"))
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r", "total")).alias("x"))
    return best.select("lang", "phrase", "a", "x.l", "x.r", F.col("x.total").alias("n"), "x.score")


def ranked(rows: DataFrame, top: int, spark: SparkSession) -> DataFrame:
    """The first ``top`` of each lang, with their rank."""
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    placed = kept(running_total(rows, order, out="place"), spark, "phrases-placed")
    starts = placed.groupBy("lang").agg(F.min("place").alias("start"))
    starts = F.broadcast(starts) if starts.count() <= MAX_BROADCAST else starts
    rank = F.col("place") - F.col("start") + 1
    return placed.join(starts, "lang").where(rank <= top).select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, spark: SparkSession | None = None, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score."""
    spark = spark or docs.sparkSession
    pieces = kept(pieces_of(docs), spark, "phrases-pieces")
    words = F.length("piece") - F.length(F.replace("piece", F.lit(" "), F.lit(""))) + 1
    totals = kept(pieces.groupBy("lang").agg(F.sum(F.col("n") * words).alias("total")), spark, "phrases-totals")
    single = kept(counted(pieces, _WORDS, None, least), spark, "phrases-1")
    pairs = kept(counted(pieces, _PAIRS, bitmap_of(single), least), spark, "phrases-2")
    longer = kept(counted(pieces, _LONGER, bitmap_of(pairs), least), spark, "phrases-3")
    return ranked(scored(pairs.unionByName(longer), single, totals), top, spark)


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, array_to_string(ws[s:s + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM w, range(1, 6) r(k))),
f AS (SELECT lang, k AS len, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, len, phrase, a FROM f WHERE len > 1),
x AS (SELECT DISTINCT s.lang, s.phrase FROM c s JOIN c y ON s.lang = y.lang AND s.len < y.len AND contains(' ' || y.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * y.a >= 100 * s.a),
q AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS ws FROM (SELECT c.*, unnest(range(1, len)) AS k FROM c ANTI JOIN x USING (lang, phrase))),
e AS (SELECT q.lang, q.phrase, q.a, k, l.a AS l, r.a AS r, n, (CAST(1000 AS HUGEINT) * q.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS score FROM q JOIN f l ON q.lang = l.lang AND l.phrase = array_to_string(ws[1:k], ' ') JOIN f r ON q.lang = r.lang AND r.phrase = array_to_string(ws[k + 1:], ' ') JOIN t ON q.lang = t.lang),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM e),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM b WHERE i = 1)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 2000"""
