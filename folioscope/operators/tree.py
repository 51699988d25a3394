"""Trees of headings from their levels, and matching of headings with wanted titles.

A document's headings are ordered by idx; its levels are few, so parents come from one window function for each level
instead of a self-join over pairs of headings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.operators.latest import running_total

LEVELS = 4


def normal_title(title: Column) -> Column:
    """Without white space, numbering and end marks."""
    s = F.regexp_replace(title, r"(?U)\s+", "")
    s = F.regexp_replace(s, r"^(第[一二三四五六七八九十百0-9]+[章节部分]+|[（(][一二三四五六七八九十0-9]+[）)]|[一二三四五六七八九十]+[、.．]|[0-9]+([.．][0-9]+)*[、.．]?)", "")
    return F.regexp_replace(s, "[：:。.…]+$", "")


def title_number(title: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(title), r"^(第[一二三四五六七八九十百0-9]+[章节]|[（(][一二三四五六七八九十0-9]+[）)]|[一二三四五六七八九十]+(?=[、.．])|[0-9]+([.．][0-9]+)*)", 1), F.lit(""))


def level_of(title: Column) -> Column:
    """1 chapter, 2 一、, 3 （一）, 4 numbers; null otherwise."""
    s = F.trim(title)
    return F.when(s.rlike("^第[一二三四五六七八九十百0-9]+[章节]"), 1).when(s.rlike("^[一二三四五六七八九十]+[、.．]"), 2).when(s.rlike("^[（(][一二三四五六七八九十]+[）)]"), 3).when(s.rlike("^([0-9]+[、.．]|[（(][0-9]+[）)])"), 4)


def heading_score(font: Column, title: Column, spans: Column) -> Column:
    """0.5, and more for a large font, a short title and a single span."""
    return 0.5 + F.when(font >= 13, 0.2).otherwise(0.0) + F.when(F.length(title) <= 30, 0.1).otherwise(0.0) + F.when(spans == 1, 0.1).otherwise(0.0)


def with_parents(h: DataFrame, doc: str = "doc_id", idx: str = "idx", level: str = "level", levels: int = LEVELS) -> DataFrame:
    """Adds parent_idx: the nearest heading before with a smaller level (null: none)."""
    before = W.partitionBy(doc).orderBy(idx).rowsBetween(W.unboundedPreceding, -1)
    last = {k: F.last(F.when(F.col(level) == k, F.col(idx)), ignorenulls=True).over(before) for k in range(1, levels)}
    cols = h.withColumns({f"__last{k}": c for k, c in last.items()})
    parent = F.lit(None).cast("int")
    for k in range(2, levels + 1):
        parent = F.when(F.col(level) == k, F.greatest(*[F.col(f"__last{j}") for j in range(1, k)], F.lit(None).cast("int"))).otherwise(parent)
    return cols.withColumn("parent_idx", parent).drop(*[f"__last{k}" for k in last])


def with_ends(h: DataFrame, last_page: Column, doc: str = "doc_id", idx: str = "idx", level: str = "level", page: str = "page", levels: int = LEVELS) -> DataFrame:
    """Adds next_idx (the next heading of the same or a smaller level) and end_page (before it; last_page without one)."""
    after = W.partitionBy(doc).orderBy(idx).rowsBetween(1, W.unboundedFollowing)
    nxt = {k: F.first(F.when(F.col(level) <= k, F.struct(F.col(idx).alias("idx"), F.col(page).alias("page"))), ignorenulls=True).over(after) for k in range(1, levels + 1)}
    cols = h.withColumns({f"__next{k}": c for k, c in nxt.items()})
    pick = F.lit(None)
    for k in range(1, levels + 1):
        pick = F.when(F.col(level) == k, F.col(f"__next{k}")).otherwise(pick)
    cols = cols.withColumn("__next", pick)
    end = F.when(F.col("__next").isNull(), last_page).otherwise(F.greatest(F.col(page), F.col("__next.page") - 1))
    return cols.withColumn("next_idx", F.col("__next.idx")).withColumn("end_page", end).drop("__next", *[f"__next{k}" for k in nxt])


def with_paths(h: DataFrame, title: str = "title", doc: str = "doc_id", idx: str = "idx", levels: int = LEVELS, sep: str = " / ") -> DataFrame:
    """Adds path: the titles from the root down (h has parent_idx). As many look-ups as there are levels."""
    out = h.withColumn("path", F.col(title)).withColumn("__up", F.col("parent_idx"))
    nodes = h.select(F.col(doc).alias("__d"), F.col(idx).alias("__i"), F.col(title).alias("__t"), F.col("parent_idx").alias("__p"))
    for _ in range(levels - 1):
        j = out.join(nodes, (F.col(doc) == F.col("__d")) & (F.col("__up") == F.col("__i")), "left")
        j = j.withColumn("path", F.when(F.col("__t").isNotNull(), F.concat(F.col("__t"), F.lit(sep), F.col("path"))).otherwise(F.col("path"))).withColumn("__up", F.col("__p"))
        out = j.select(*h.columns, "path", "__up")
    return out.drop("__up")


def best_matches(h: DataFrame, aliases: Sequence[tuple[str, str, str | None]], title: str = "normalized_title", path: str = "path", doc: str = "doc_id", idx: str = "idx", accept: float = 0.6) -> DataFrame:
    """Per document and target the best heading: doc, target, idx, confidence.

    aliases: (target, alias, words of the parent that add to it or None). 1 for equal titles, 0.85 if one contains the
    other, 0.05 more for the parent; equal ones go to the smaller idx.
    """
    table = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(a).alias("alias"), F.lit(p).cast("string").alias("parent")) for t, a, p in aliases])
    rows = h.select(doc, idx, F.col(title).alias("__t"), F.col(path).alias("__p"), F.explode(table).alias("a"))
    t, a = F.col("__t"), F.col("a.alias")
    base = F.when(t == a, 1.0).when((t != "") & (F.contains(t, a) | F.contains(a, t)), 0.85).otherwise(0.0)
    extra = F.when((base > 0) & F.coalesce(F.contains(F.col("__p"), F.col("a.parent")), F.lit(False)), 0.05).otherwise(0.0)
    conf = F.least(F.lit(1.0), F.round(base + extra, 4))
    best = rows.withColumn("confidence", conf).where(F.col("confidence") >= accept).groupBy(doc, F.col("a.target").alias("target"))
    return best.agg(F.max(F.struct("confidence", (-F.col(idx)).alias("o"))).alias("m")).select(doc, "target", (-F.col("m.o")).alias(idx), F.col("m.confidence").alias("confidence"))


def with_ids(h: DataFrame, first_id: int = 1, doc: str = "doc_id", idx: str = "idx") -> DataFrame:
    """Adds id and parent_id for storing (h has parent_idx): ids are unique over all documents and repeatable.

    A document's headings are numbered within it, documents get ranges by a running total over the table of documents.
    """
    sizes = h.groupBy(doc).agg(F.count(F.lit(1)).alias("__n"))
    sizes = running_total(sizes, [F.col(doc)], F.col("__n"), "__before")
    starts = sizes.select(F.col(doc).alias("__d"), (F.col("__before") + first_id).alias("__start"))
    place = F.row_number().over(W.partitionBy(doc).orderBy(idx)) - 1
    rows = h.withColumn("__place", place).join(starts, F.col(doc) == F.col("__d")).withColumn("id", F.col("__start") + F.col("__place"))
    ids = F.map_from_entries(F.collect_list(F.struct(F.col(idx), F.col("id"))).over(W.partitionBy(doc)))
    return rows.withColumn("parent_id", F.try_element_at(ids, F.col("parent_idx").cast(h.schema[idx].dataType))).select(*h.columns, "id", "parent_id")
