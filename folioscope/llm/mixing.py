"""Mixing sources to target weights through a splitting tree over block quotas.

1. Sizes: a document's size is its number of words; a source's size is the sum of them.
2. Targets: sources, by code point with null last, take the weights in turn and share
   ``share`` times all words; a target stops at ``cap`` times its source's size and the excess is
   shared anew by weight until no target is above. That fixed point is found in one pass over the
   sources sorted by cap / weight (prefix sums; the table has one row for each source).
3. Blocks: a source's documents fall by hash into blocks. Blocks are drawn in permuted order
   without replacement: whole epochs first, then a last epoch up to the block in which the
   target is reached. In that block documents are drawn, again in permuted order, while that
   brings the total nearer to the target. Prefix sums run over blocks of a source, over SUBS parts of
   that one block and over documents of a part, never over all documents of a source or a block.
4. Splitting tree: the quotas (numbers of block draws of each source) are split between two halves
   of the output shards by a multivariate hypergeometric draw, each half again, and so on down to
   single shards. So every shard holds an exact random part of every source's draws, and the
   draws of shards are disjoint.
5. Within its shard a document stands at a place given by a hash: a local shuffle.

Everything is seeded and depends on the rows alone, so reruns agree. Only the quotas of sources come to the driver, one each
up to MAX_STRATA sources. Beyond that neighbouring sources share a row there, and the permuted order of their draws, of which shards
take runs, splits it between them: a hypergeometric draw again, so each source's own quota stays exact. Sources are a narrow
table of one row each; ranks and levels of it take one task.

Defined results: null or blank text has size 0 and takes 0; null sources form one source; repeated rows
count each; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm._shared import kept, pick, word_count

WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2
SHARDS, SEED = 16, 20240
DOCS_PER_BLOCK, MAX_BLOCKS, MAX_STRATA = 32, 4096, 4096
#: Parts of the block in which a target is reached, by the leading bits of the hash that orders it.
SUBS = 4096
#: Rows of narrow tables (sources, blocks, documents at a cut) that may be broadcast.
MAX_BROADCAST = 200_000


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """by_source: source, source_size, n_docs (a row for each source). Adds weight and target."""
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("limit", F.col("source_size") * cap)
    tight = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = tight.rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    level = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("limit"))
    rest = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(tight.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * rest)
    return level.select("source", "source_size", "n_docs", "weight", target.alias("target"))


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """Number of good ones among n drawn without replacement: inverse of the distribution, from its mode outwards."""
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    lg = math.lgamma
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))

    def log_p(k: int) -> float:
        return lg(good + 1) - lg(k + 1) - lg(good - k + 1) + lg(bad + 1) - lg(n - k + 1) - lg(bad - n + k + 1) - (lg(good + bad + 1) - lg(n + 1) - lg(good + bad - n + 1))

    u, p = rng.random(), math.exp(log_p(mode))
    left, right, pl, pr = mode, mode, p, p
    u -= p
    while u > 0 and (left > low or right < high):
        if right < high:
            pr *= (good - right) * (n - right) / ((right + 1) * (bad - n + right + 1))
            right += 1
            u -= pr
            if u <= 0:
                return right
        if left > low:
            pl *= left * (bad - n + left) / ((good - left + 1) * (n - left + 1))
            left -= 1
            u -= pl
            if u <= 0:
                return left
    return mode


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """[shard][source] -> draws. Sums over shards are the quotas; shard totals differ by 1 at most for a power of 2."""
    rng, out = random.Random(seed), []

    def split(own: list[int], n: int) -> None:
        if n == 1:
            out.append(own)
            return
        half, total = n // 2, sum(own)
        take = total * half // n
        left, rest = [], total
        for q in own:
            rest -= q
            got = hypergeometric(rng, q, rest, take)
            left.append(got)
            take -= got
        split(left, half)
        split([a - b for a, b in zip(own, left, strict=True)], n - half)

    split(list(quotas), shards)
    return out


def _hash(doc_id, text, seed: int):
    return F.xxhash64(F.lit(seed), doc_id, F.xxhash64(text))


def _plan(base: DataFrame, spark: SparkSession, weights: tuple[int, ...], share: float, cap: int, shards: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(g_source, blocks) of all sources, and all blocks: t_source, t_block, last, missing, epochs, source_size, target, shards."""
    goals = targets(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    goals = goals.withColumn("blocks", F.greatest(F.lit(1), F.least(F.lit(MAX_BLOCKS), F.ceil(F.col("n_docs") / DOCS_PER_BLOCK)))).withColumn("epochs", whole)
    goals = goals.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumnRenamed("source", "g_source")
    rank, all_ = F.row_number().over(W.orderBy(F.col("g_source").asc_nulls_last())) - 1, F.count(F.lit(1)).over(W.partitionBy())
    goals = goals.withColumn("rank", rank).withColumn("n_sources", all_)
    goals = goals.withColumn("stratum", F.when(F.col("n_sources") <= MAX_STRATA, F.col("rank")).otherwise(F.floor(F.col("rank") * MAX_STRATA / F.col("n_sources"))).cast("int")).drop("rank", "n_sources")
    goals = kept(goals, spark, "mix-targets")
    words = _blocked(base, goals).groupBy("source", "block").agg(F.sum("size").alias("words"))
    words = words.join(goals, F.col("source").eqNullSafe(F.col("g_source"))).drop("g_source")
    upto = F.sum("words").over(W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, 0))
    words = words.withColumn("before", upto - F.col("words")).withColumn("missing", F.col("rest") - F.col("before"))
    last = F.when(F.col("missing") >= F.col("words"), F.lit("all")).when(F.col("missing") > 0, F.lit("some")).otherwise(F.lit("none"))
    words = words.withColumn("last", F.when(F.col("words") == 0, F.lit("none")).otherwise(last))
    draws = F.col("epochs") + (F.col("last") != "none").cast("int")
    words = words.withColumn("draws", draws)
    words = kept(words, spark, "mix-blocks")
    tree = kept(_assign(words, spark, shards, seed).withColumnsRenamed({"source": "t_source", "block": "t_block"}), spark, "mix-draws")
    return goals.select("g_source", "blocks"), tree


def _small(df: DataFrame) -> DataFrame:
    """To be broadcast if it is counted to be small; else Spark decides."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _blocked(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """rows (source, h) with their block."""
    return rows.join(_small(goals.select("g_source", "blocks")), F.col("source").eqNullSafe(F.col("g_source"))).withColumn("block", F.pmod(F.col("h"), F.col("blocks"))).drop("blocks", "g_source")


def _in_block():
    return F.col("source").eqNullSafe(F.col("t_source")) & (F.col("block") == F.col("t_block"))


def _nearer(cut: DataFrame) -> DataFrame:
    """The documents of blocks in which targets are reached, with yes: whether the document brings the total nearer to it."""
    part = F.shiftright("h", 64 - SUBS.bit_length() + 1)
    cut = cut.withColumn("sub", part)
    block = ["t_source", "t_block"]
    parts = cut.groupBy(*block, "sub").agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(W.partitionBy(*block).orderBy("sub").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    parts = parts.select(F.col("t_source").alias("p_source"), F.col("t_block").alias("p_block"), F.col("sub").alias("p_sub"), upto.alias("until"))
    cut = cut.join(parts, F.col("t_source").eqNullSafe(F.col("p_source")) & (F.col("t_block") == F.col("p_block")) & (F.col("sub") == F.col("p_sub")))
    within = W.partitionBy(*block, "sub").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    yes = F.col("until") + F.sum("size").over(within) - F.col("size") / 2 <= F.col("missing")
    return cut.withColumn("yes", yes).drop("p_source", "p_block", "p_sub", "until", "sub")


def mix(docs: DataFrame, spark: SparkSession | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """A row for each document: doc_id, source, size, source_size, target, copies, shards, place, taken.

    copies: times the mix takes the document; taken: words that makes; shards: the output shard of each copy; place: its
    place there.
    """
    spark = spark or docs.sparkSession
    own = pick(docs, "doc_id", "source", "text")
    base = kept(own.select("doc_id", "source", word_count(F.col("text")).alias("size"), _hash(F.col("doc_id"), F.col("text"), seed).alias("h")), spark, "mix-sizes")
    goals, tree = _plan(base, spark, weights, share, cap, shards, seed)
    rows = _blocked(base, goals).join(tree, _in_block())
    cut = _nearer(rows.where("last = 'some'"))
    rows = rows.where("last <> 'some'").withColumn("yes", F.col("last") == "all").unionByName(cut)
    extra = F.col("yes").cast("int")
    copies = F.when(F.col("size") > 0, F.col("epochs") + extra).otherwise(0).cast("int")
    out = rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), "shards", F.xxhash64(F.lit(seed + 1), "h").alias("place"))
    return out.withColumn("taken", F.col("copies") * F.col("size")).withColumn("shards", F.slice("shards", F.lit(1), F.col("copies")))


def _assign(words: DataFrame, spark: SparkSession, shards: int, seed: int) -> DataFrame:
    """Blocks with the output shard of each of their draws."""
    quota = words.groupBy("stratum").agg(F.sum("draws").alias("n")).orderBy("stratum").collect()  # MAX_STRATA rows at most
    rows, split = [], split_quotas([r["n"] or 0 for r in quota], shards, seed)
    for k, r in enumerate(quota):
        low = 0
        for s in range(shards):
            if n := split[s][k]:
                rows.append(f"{r['stratum']}:{s}:{low}:{low + n}")
                low += n
    # a stratum's draws are numbered in a permuted order, and shards take runs of the numbers
    lists = spark.range(1).select(F.explode(F.split(F.lit(",".join(rows)), ",")).alias("x")).where("x <> ''").select(*[F.split("x", ":")[i].cast("long").alias(c) for i, c in enumerate(("q_stratum", "q_shard", "q_low", "q_high"))])
    each = words.where("draws > 0").select("source", "block", "stratum", F.explode(F.sequence(F.lit(0), F.col("draws") - 1)).alias("draw"))
    number = F.row_number().over(W.partitionBy("stratum").orderBy(F.xxhash64(F.lit(seed), "source", "block", "draw"), "source", "block", "draw")) - 1
    each = each.withColumn("number", number)
    got = each.join(lists, (F.col("stratum") == F.col("q_stratum")) & (F.col("number") >= F.col("q_low")) & (F.col("number") < F.col("q_high")))
    got = got.groupBy("source", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("draw", "q_shard"))), lambda x: x["q_shard"].cast("int")).alias("shards"))
    got = got.select(F.col("source").alias("g_source"), F.col("block").alias("g_block"), "shards")
    return words.join(got, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("block") == F.col("g_block")), "left").select("source", "block", "last", "missing", "epochs", "source_size", "target", F.coalesce("shards", F.array().cast("array<int>")).alias("shards"))


def mixed_documents(docs: DataFrame, spark: SparkSession | None = None, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, shards: int = SHARDS, seed: int = SEED, placed: bool = False) -> DataFrame:
    """The mix itself: docs' columns, a row for each copy that is taken. placed: with out_shard and out_place of each.

    Texts are not shuffled while the blocks (at most MAX_BLOCKS a source) are few enough to be broadcast; what is decided
    document by document (the blocks in which targets are reached) is decided on ids and sizes.
    """
    spark = spark or docs.sparkSession
    cols = docs.columns
    inner = [f"c{i}" for i in range(len(cols))]
    doc_id, source, text = (F.col(f"c{cols.index(c)}") for c in ("doc_id", "source", "text"))
    rows = docs.toDF(*inner).withColumn("source", source).withColumn("h", _hash(doc_id, text, seed))
    base = kept(rows.select(doc_id.alias("doc_id"), "source", word_count(text).alias("size"), "h"), spark, "mix-sizes")
    goals, tree = _plan(base, spark, weights, share, cap, shards, seed)
    cut = _nearer(_blocked(base, goals).join(_small(tree.where("last = 'some'")), _in_block())).where(F.col("yes") & (F.col("size") > 0))
    chosen = kept(cut.select(F.col("source").alias("y_source"), F.col("h").alias("y_h"), F.col("doc_id").alias("y_id")).distinct(), spark, "mix-chosen")
    out = _blocked(rows, goals).join(_small(tree), _in_block())
    out = out.join(_small(chosen), (F.col("h") == F.col("y_h")) & doc_id.eqNullSafe(F.col("y_id")) & F.col("source").eqNullSafe(F.col("y_source")), "left")
    extra = F.when((F.col("last") == "all") | F.col("y_h").isNotNull(), 1).otherwise(0)
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    copies = F.when(worded, F.col("epochs") + extra).otherwise(0)
    taken = out.withColumn("out_shard", F.explode(F.slice("shards", F.lit(1), copies))).withColumn("out_place", F.xxhash64(F.lit(seed + 1), "h", "out_shard"))
    own = ["out_shard", "out_place"] if placed else []
    return taken.select(*inner, *own).toDF(*cols, *own)


def write_mix(docs: DataFrame, path: str, files: int = 1, **options) -> None:
    """Writes the mix as one folder for each output shard, its rows shuffled; files: parts (and tasks) of a shard."""
    mixed = mixed_documents(docs, placed=True, **options)
    part = F.pmod("out_place", F.lit(files))
    mixed.repartition(F.col("out_shard"), part).sortWithinPartitions("out_shard", "out_place").drop("out_place").write.mode("overwrite").partitionBy("out_shard").parquet(path)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target: a row for each document."""
    rows = pick(docs, "doc_id", "source", "text").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    goals = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")))
    goals = goals.select(F.col("source").alias("g_source"), "source_size", "target")
    return rows.join(goals, F.col("source").eqNullSafe(F.col("g_source"))).select("doc_id", "size", "source_size", "target")


_TIGHT = "OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
SIZED_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
r AS (SELECT *, {list(WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight, source_size * {CAP} AS lim FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY lim / weight, source NULLS LAST) AS o, (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(lim) {_TIGHT}, 0)) / (sum(weight) OVER () - coalesce(sum(weight) {_TIGHT}, 0)) AS level FROM r),
f AS (SELECT *, level * weight >= lim AS is_full FROM l),
t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(lim AS DOUBLE) ELSE weight * (SELECT arg_min(level, o) FROM f WHERE NOT is_full) END AS target FROM f)
SELECT doc_id, size, source_size, target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source"""
