"""URL filter: a tree of path templates for every host, and smoothed labelled purity.

1. A url's host, path and the longest rule that fits it are column expressions. Urls that a rule
   decides are the labelled ones (allow or block).
2. Templates: a path's segments, where variable ones (numbers, dates, hex and other ids,
   also with an extension) become wildcards at once; segments from the LEVELS-th on are one segment together, so paths of any
   length count whole. Urls are counted by host and template, so what follows sees one row for each distinct template, not for each url.
3. Merging, from the leaves up: siblings (same host and prefix) are merged into a wildcard when they have little support, or
   when both they and the rest are labelled and their rates do not differ by more than the z-test's bound. Where labels say nothing a
   branch with support stays, but in places of VARIABLE or more different segments, which are variable, only if it has its share of the
   urls. Branches without support are never joined with anything; totals of siblings are aggregated and joined to the rest.
4. Purity: every node of the tree (a host, a prefix of a template, a template) counts the labelled urls below it. A node's
   purity is its share of blocked ones, smoothed by PRIOR urls of its prior. Its prior is the mean rate of its labelled siblings,
   each counting as one whatever its size (a merged one as the labelled branches in it), and of its parent's prior, counting as BRANCHES of them. Hosts are siblings under
   their domain suffix, suffixes under the root, whose prior is one half. So one labelled branch says little of the branch beside it, many say much.
5. Verdict: the rule's where one fits; otherwise block if the purity of the url's template is above BLOCK.

Defined results: a null url or one without "://" has an empty host and path, no rule and verdict allow
(nothing speaks against it); repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm._shared import LOWER, UPPER, kept, pick

#: (verdict, host and path): a rule fits its host and all subdomains if the path starts with the rule's.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Segments that count each by itself (and the rest together), urls that a prior counts as, siblings that a parent's prior counts
#: as, purity above which a template is rejected, support of a branch of its own, bound of the z-test, different segments of a variable place.
LEVELS, PRIOR, BRANCHES, BLOCK, SUPPORT, Z, VARIABLE = 6, 10.0, 2.0, 0.8, 3, 1.96, 20
WILD = "*"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end; A-Z lower-cased; empty without "://"."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end; empty without "://"."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Index of the longest rule that fits (null: none)."""
    out = F.lit(None).cast("int")
    order = sorted(range(len(rules)), key=lambda i: (len(rules[i][1]), -i))
    whens = None
    for i in reversed(order):
        h, slash, p = rules[i][1].partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(slash + p))
        whens = F.when(fits, F.lit(i)) if whens is None else whens.when(fits, F.lit(i))
    return out if whens is None else whens


def segment(s: Column) -> Column:
    """A segment, or a wildcard if it looks like a value: it has a digit run with nothing but an id's characters around."""
    stem = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
    value = stem.rlike(r"^[0-9]+$") | stem.rlike(r"^[0-9]{1,4}[-_.][0-9]{1,2}([-_.][0-9]{1,4})?$") | stem.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{6,}$") | (stem.rlike(r"[0-9]{3,}")) | (F.length(stem) > 40)
    return F.when(value, F.lit(WILD)).otherwise(F.when(s == WILD, F.lit("%2A")).otherwise(s))


def segments_of(path: Column, levels: int = LEVELS) -> Column:
    parts = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), segment)
    rest = F.array(F.array_join(F.slice(parts, levels, F.greatest(F.size(parts) - levels + 1, F.lit(0))), "/"))
    return F.when(F.size(parts) > levels, F.concat(F.slice(parts, 1, levels - 1), rest)).otherwise(parts)


def suffix_of(host: Column) -> Column:
    """The host's last label but for its port: what hosts without labels of their own fall back to."""
    return F.element_at(F.split(F.regexp_replace(host, r":[0-9]*$", ""), r"\."), -1)


def merged(base: DataFrame, spark: SparkSession, levels: int) -> DataFrame:
    """base: host, segs, n, k, bad (distinct templates). Adds t: the template after merging, from the leaves up."""
    base = base.withColumn("t", F.col("segs"))
    sums = [F.sum(c).alias(c) for c in ("n", "k", "bad")]
    for d in range(levels, 0, -1):
        deep = F.size("t") >= d
        head, own = F.slice("t", 1, d - 1), F.get("t", F.lit(d - 1))
        at = base.where(deep).groupBy("host", head.alias("head"), own.alias("own")).agg(*sums)
        all_ = at.groupBy(F.col("host").alias("h"), F.col("head").alias("p")).agg(F.sum("n").alias("an"), F.sum("k").alias("ak"), F.sum("bad").alias("ab"), F.count(F.lit(1)).alias("kinds"))
        j = at.where((F.col("n") >= SUPPORT) & (F.col("own") != WILD)).join(all_, (F.col("host") == F.col("h")) & (F.col("head") == F.col("p")))
        rest_k, rest_b = F.col("ak") - F.col("k"), F.col("ab") - F.col("bad")
        pooled = F.col("ab") / F.col("ak")
        err = F.sqrt(pooled * (1 - pooled) * (1 / F.col("k") + 1 / rest_k))
        # (without siblings the wildcard stands for the same urls)
        alone = (F.col("an") > F.col("n")) & ((F.col("kinds") < VARIABLE) | (VARIABLE * F.col("n") >= F.col("an")))
        stays = F.when((F.col("k") > 0) & (rest_k > 0), F.abs(F.col("bad") / F.col("k") - rest_b / rest_k) > Z * err).otherwise(alone)
        keep = j.where(F.coalesce(stays, F.lit(False))).select("h", "p", F.col("own").alias("o"))
        marked = base.join(keep, deep & (F.col("host") == F.col("h")) & (head == F.col("p")) & (own == F.col("o")), "left")
        wild = F.concat(head, F.array(F.lit(WILD)), F.slice("t", d + 1, levels))
        base = kept(marked.select("host", "segs", "n", "k", "bad", F.when(deep & F.col("o").isNull(), wild).otherwise(F.col("t")).alias("t")), spark, f"url-level-{d}")
    return base


def _priors(nodes: DataFrame, above: DataFrame, up: list[str]) -> DataFrame:
    """nodes (up, k, bad, m: labelled branches in it) with their prior: from their siblings, which agree in the columns up, and above (up, above: the parent's prior)."""
    rate = F.coalesce(F.when(F.col("k") > 0, F.col("m") * F.col("bad") / F.col("k")), F.lit(0.0))
    total = nodes.groupBy(*[F.col(c).alias(f"__{c}") for c in up]).agg(F.sum(rate).alias("__rates"), F.sum("m").alias("__m"))
    total = total.join(above.select(*[F.col(c).alias(f"a_{c}") for c in up], "above"), [F.col(f"__{c}") == F.col(f"a_{c}") for c in up])
    j = nodes.join(total, [F.col(c) == F.col(f"__{c}") for c in up])
    others, m = F.col("__rates") - rate, F.col("__m") - F.col("m")
    return j.withColumn("prior", (others + BRANCHES * F.col("above")) / (m + BRANCHES)).select(*nodes.columns, "prior")


def tree(urls: DataFrame, spark: SparkSession, levels: int = LEVELS) -> DataFrame:
    """urls: host, segs, label (1 block, 0 allow, null none). Returns host, segs, template, purity (a row for each distinct template)."""
    base = urls.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("k"), F.coalesce(F.sum("label"), F.lit(0)).alias("bad"))
    base = kept(base, spark, "url-templates")
    depth = base.agg(F.max(F.size("segs"))).first()[0] or 0
    base = merged(base, spark, min(levels, depth))
    prefixes = F.explode(F.transform(F.sequence(F.lit(0), F.size("t")), lambda i: F.struct(F.slice(F.col("t"), F.lit(1), i).alias("t"), F.slice(F.col("segs"), F.lit(1), i).alias("own")))).alias("x")
    nodes = base.select("host", "k", "bad", prefixes).groupBy("host", F.col("x.t").alias("t")).agg(F.sum("k").alias("k"), F.sum("bad").alias("bad"), F.countDistinct(F.when(F.col("k") > 0, F.col("x.own"))).alias("m"))
    nodes = kept(nodes.withColumn("suffix", suffix_of(F.col("host"))).withColumn("root", F.lit(0)), spark, "url-nodes")
    hosts = nodes.where(F.size("t") == 0)
    root = spark.range(1).select(F.lit(0).alias("root"), F.lit(0.5).alias("above"))
    suffixes = _priors(hosts.groupBy("root", "suffix").agg(F.sum("k").alias("k"), F.sum("bad").alias("bad"), F.max("m").alias("m")), root, ["root"])
    level = _priors(hosts, suffixes.select("suffix", F.col("prior").alias("above")), ["suffix"]).select("host", "t", "k", "bad", "prior")
    out = level
    for d in range(1, min(levels, depth) + 1):
        own = nodes.where(F.size("t") == d).select("host", "t", "k", "bad", "m", F.slice("t", 1, d - 1).alias("head"))
        level = _priors(own, level.select("host", F.col("t").alias("head"), F.col("prior").alias("above")), ["host", "head"]).select("host", "t", "k", "bad", "prior")
        level = kept(level, spark, f"url-priors-{d}")
        out = out.union(level)
    pure = out.select(F.col("host").alias("h"), F.col("t").alias("x"), ((F.col("bad") + PRIOR * F.col("prior")) / (F.col("k") + PRIOR)).alias("purity"))
    return base.join(pure, (F.col("host") == F.col("h")) & (F.col("t") == F.col("x"))).select("host", "segs", F.col("t").alias("template"), "purity")


def judge(pages: DataFrame, spark: SparkSession | None = None, rules=RULES, levels: int = LEVELS, block: float = BLOCK) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: a row for each page."""
    spark = spark or pages.sparkSession
    rows = pick(pages, "page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    at = rule_of(F.col("host"), F.col("path"), rules)
    bad = F.get(F.array(*[F.lit(int(v == "block")) for v, _ in rules]), at) if rules else F.lit(None).cast("int")
    name = F.get(F.array(*[F.lit(r) for _, r in rules]), at) if rules else F.lit(None).cast("string")
    rows = kept(rows.select("page_id", "host", "path", segments_of(F.col("path"), levels).alias("segs"), name.alias("rule"), bad.alias("label")), spark, "url-rows")
    found = tree(rows.where("host <> ''"), spark, levels).withColumnsRenamed({"host": "t_host", "segs": "t_segs"})
    # the side of distinct templates is joined by Spark's choice; a host's urls may be many, so its templates are what is joined on
    j = rows.join(found, (F.col("host") == F.col("t_host")) & (F.col("segs") == F.col("t_segs")), "left")
    own = F.when(F.coalesce(F.col("purity"), F.lit(0.0)) > block, "block").otherwise("allow")
    verdict = F.when(F.col("label") == 1, "block").when(F.col("label") == 0, "allow").otherwise(own)
    return j.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity")


def ruled(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule: what the rules alone say."""
    rows = pick(pages, "page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return rows.withColumn("rule", F.get(F.array(*[F.lit(r) for _, r in rules]), rule_of(F.col("host"), F.col("path"), rules)))


#: The longest of RULES first, as rule_of tries them.
RULES_SQL = """
WITH u AS (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, CASE """ + " ".join(f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'" for _, r in sorted(RULES, key=lambda x: -len(x[1]))) + " END AS rule FROM h"
