"""Personal data: fixed patterns, and contexts that are learned from what they find.

1. Base: e-mail addresses, IPv4 addresses, card numbers and phone numbers by expressions, leftmost and without overlap for
   each kind; matches that fail their check (parts, Luhn, digits) are dropped. Places count code points.
2. Candidates: identifier-like tokens that no base span touches: runs of
   non-blank characters with an "@" and something else, or with at least MIN_SIGNS digits, without the punctuation around them; also
   neighbouring groups of digits and signs on one line as one token ("(555) 123 456"), if they have as many digits together.
3. Lexical patterns: the last word and the last two words before a span, the first and the first two after it, as far as no other
   span stands between.
4. Bootstrapping: patterns and values form a graph. Seeds are the values of base spans. In each of ROUNDS rounds the seeds known
   so far induce patterns (those beside SUPPORT different seeds or more; of the kind that most of these have); a pattern's
   confidence is the sum of the scores of its values over all occurrences of its words in the corpus, so a word that precedes
   anything else has next to none; a value's score is the noisy-or of its patterns' confidences, and 1 for base seeds; values with a
   score of ACCEPT or more are seeds of the next round. A round is two joins and three aggregations.
5. Accepted values are found wherever a pattern of CONFIDENT or more stands beside them, with that pattern's kind. Of found spans
   within another the longer counts.

Base spans are never changed; a found span that overlaps a base span is left out. All of it is column expressions. Only patterns
beside SUPPORT different values can ever be induced; only their words are counted in the corpus, in one scan, before anything is
shuffled while these patterns are few enough to be broadcast. Expressions read each run of characters once and don't nest, so
texts of any length and form take linear time.

Defined results: null and empty texts have no spans; repeated rows give equal rows; rows without doc_id are kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.functions.places import last_until
from folioscope.llm._shared import kept, let, pick

KINDS = ("email", "ip", "card", "phone")
# A match starts at the beginning of a run of its first characters or right after the last match, so runs are read once.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain to be searched for a kind.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
ROUNDS, SUPPORT, ACCEPT, CONFIDENT, MIN_SIGNS = 4, 3, 0.9, 0.5, 4
#: Patterns whose words may be broadcast; beyond that they are joined by a shuffle of counts.
MAX_BROADCAST = 200_000
#: Matches whose places are summed up together.
STRIDE = 128
#: Characters of the pieces that contexts are read from.
PIECE = 1024


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def total(ds: Column) -> Column:
        n = F.size(ds)

        def part(d: Column, i: Column) -> Column:
            v = d.cast("int")
            twice = (n - 1 - i) % 2 == 1
            return F.when(twice, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v)

        return F.aggregate(F.transform(ds, part), F.lit(0), lambda a, x: a + x)

    return let(F.split(digits, "(?!^)(?!$)"), total) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?!$)", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) < 3) | (F.length(part(p)) == 3) & (part(p) <= "255"))
    if kind == "card":
        return let(_digits(m), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def spans_of(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches, in code points; pieces between matches give the places."""

    def placed(ms: Column) -> Column:
        return let(F.transform(F.split(text, pattern, -1), F.length), lambda gaps: _sums(gaps, ms))

    def _sums(gaps: Column, ms: Column) -> Column:
        # places are running sums of lengths: within strides of matches, then over strides, so long lists stay cheap
        at = F.sequence(F.lit(0), F.floor((F.size(ms) - 1) / STRIDE).cast("int"))
        pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(ms)), ms, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
        strides = let(pairs, lambda ps: F.transform(F.transform(at, lambda i: F.slice(ps, i * STRIDE + 1, F.lit(STRIDE))), local))
        return let(strides, lambda ss: F.flatten(F.zip_with(ss, _starts(ss), lambda s, base: F.transform(s["out"], lambda x: F.struct((base + x["start"]).alias("start"), (base + x["end"]).alias("end"), x["value"].alias("value"))))))

    def local(part: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_PLACES).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + F.length(x["m"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value")))).alias("out"))

        return F.aggregate(part, zero, step)

    def _starts(strides: Column) -> Column:
        return F.aggregate(F.transform(strides, lambda s: s["at"]), F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)), lambda acc: F.slice(acc, F.lit(1), F.size(acc) - 1))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda ms: F.when(F.size(ms) > 0, placed(ms)).otherwise(F.array().cast(_PLACES)))


#: Base spans of a text that each token is held against one by one.
FEW = 8
_PLACES = "array<struct<start:int,end:int,value:string>>"
_SPANS = "array<struct<start:int,end:int,kind:int,value:string>>"


def base_spans(text: Column) -> Column:
    """All base spans of a text: array<struct<start, end, kind (index), value>> by start, then kind."""
    found = []
    for k, kind in enumerate(KINDS):
        hits = _checked(text, k, kind)
        need = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike("[0-9]")
        found.append(F.when(need, hits).otherwise(F.array().cast(_SPANS)))
    ordered = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1).otherwise(0)
    return F.coalesce(F.array_sort(F.concat(*found), ordered), F.array().cast(_SPANS))


def _checked(text: Column, k: int, kind: str) -> Column:
    ok = F.filter(spans_of(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
    return F.transform(ok, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind"), s["value"].alias("value")))


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


#: A blank-separated token with a digit or "@"; and several such of digits and signs alone, a blank or two apart.
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_GROUP = r"[().+/#:-]*+[0-9][0-9().,;:+/#-]*+"
_GROUPS = rf"(?<!\S){_GROUP}(?:[\x20\t\xA0]{{1,2}}{_GROUP}(?!\S))++"
#: Punctuation around a token that isn't part of it.
_BEFORE, _AFTER = r"^[^\p{L}\p{N}@+(#]++", r"(?<![^\p{L}\p{N}@)])[^\p{L}\p{N}@)]++$"


def _bare(t: Column) -> Column:
    """A place without the punctuation around its value."""
    cut = F.length(F.regexp_extract(t["value"], _BEFORE, 0))
    value = F.regexp_replace(F.regexp_replace(t["value"], _BEFORE, ""), _AFTER, "")
    return let(value, lambda v: F.struct((t["start"] + cut).alias("start"), (t["start"] + cut + F.length(v)).alias("end"), v.alias("value")))


def candidates(text: Column) -> Column:
    """array<struct<start, end, value>>: identifier-like tokens, and groups of digits as one."""
    digits = lambda s: F.length(_digits(s["value"])) >= MIN_SIGNS
    alone = F.filter(F.transform(spans_of(text, _TOKEN), _bare), lambda s: digits(s) | F.contains(s["value"], F.lit("@")) & (F.length(s["value"]) > 1))
    return F.concat(alone, F.when(text.rlike(_GROUPS), F.filter(F.transform(spans_of(text, _GROUPS), _bare), digits)).otherwise(F.array().cast(_PLACES)))


def _contexts(text: Column, marks: Column) -> Column:
    """marks with the patterns beside each: the words between it and the spans around."""
    near = range(1, 5)

    def one(t: Column, i: Column, part, size: Column) -> Column:
        # the nearest ends and starts among the neighbours that don't overlap
        low = F.greatest(F.lit(0), *[F.when(F.get(marks, i - k)["end"] <= t["start"], F.get(marks, i - k)["end"]) for k in near])
        high = F.least(size, *[F.when(F.get(marks, i + k)["start"] >= t["end"], F.get(marks, i + k)["start"]) for k in near])
        words = lambda a, b: F.filter(F.split(F.lower(part(a, b)), r"\s+"), lambda w: w != "")
        before = let(words(low, t["start"]), lambda ws: F.array(F.concat(F.lit("L:"), F.try_element_at(ws, F.lit(-1))), F.concat(F.lit("L:"), F.try_element_at(ws, F.lit(-2)), F.lit(" "), F.try_element_at(ws, F.lit(-1)))))
        after = let(words(t["end"], high), lambda ws: F.array(F.concat(F.lit("R:"), F.try_element_at(ws, F.lit(1))), F.concat(F.lit("R:"), F.try_element_at(ws, F.lit(1)), F.lit(" "), F.try_element_at(ws, F.lit(2)))))
        return F.struct(t["start"].alias("start"), t["end"].alias("end"), t["kind"].alias("kind"), t["value"].alias("value"), F.filter(F.concat(before, after), lambda p: p.isNotNull()).alias("patterns"))

    def within(whole: Column) -> Column:
        """The text from a to b is put together from the pieces there, so all gaps together cost no more than the text; its length is counted once."""
        pieces = whole["pieces"]
        piece = lambda at: F.floor(at / PIECE).cast("int")
        part = lambda a, b: F.substring(F.array_join(F.slice(pieces, piece(a) + 1, piece(b) - piece(a) + 1), ""), a - piece(a) * PIECE + 1, b - a)
        return F.transform(marks, lambda t, i: one(t, i, part, whole["size"]))

    whole = F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"), F.length(text).alias("size"))
    return F.when(F.size(marks) > 0, let(whole, within)).otherwise(F.array().cast("array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>"))


def _occurrences(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """patterns (pattern) with how often its words occur in texts, one after another, at all."""
    words = patterns.select(F.substring("pattern", 3, 1 << 30).alias("word")).distinct()
    few = words.count() <= MAX_BROADCAST
    split = texts.select(F.split(F.lower(F.col("text")), r"\s+").alias("w"))
    each = split.select(F.explode(F.concat("w", F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)))).alias("word"))
    if few:
        each = each.join(F.broadcast(words), "word", "left_semi")
    counts = each.groupBy("word").agg(F.count(F.lit(1)).alias("all"))
    return patterns.withColumn("word", F.substring("pattern", 3, 1 << 30)).join(counts, "word", "left").select("pattern", F.coalesce("all", F.lit(0)).alias("all"))


def _learned(edges: DataFrame, texts: DataFrame, spark: SparkSession, rounds: int) -> tuple[DataFrame, DataFrame] | None:
    """(pattern, kind, conf) and (value, score) after all rounds; None where nothing can be learned.

    edges: pattern, value, kind (null: a candidate); a row for each occurrence.
    """
    weighed = edges.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("times"), F.max("kind").alias("kind"))
    able = weighed.groupBy("pattern").agg(F.count(F.lit(1)).alias("values"), F.sum("times").alias("own"), F.count("kind").alias("seeds")).where(F.col("values") >= SUPPORT)
    able = kept(able.select("pattern", "own"), spark, "pii-patterns")
    if able.isEmpty():
        return None
    able = able.join(_occurrences(texts, able.select("pattern")), "pattern").select("pattern", F.greatest("all", "own").alias("all"))
    graph = kept(weighed.join(able, "pattern"), spark, "pii-graph")
    known = kept(graph.where("kind IS NOT NULL").groupBy("value").agg(F.max("kind").alias("k"), F.lit(1.0).alias("score"), F.lit(True).alias("base")), spark, "pii-seeds")
    sure = None
    for _ in range(rounds):
        scored = graph.drop("kind").join(known, "value", "left")
        by_kind = scored.groupBy("pattern", "k").agg(F.count(F.when(F.col("score") >= ACCEPT, 1)).alias("n"), F.sum(F.col("times") * F.coalesce("score", F.lit(0.0))).alias("mass"), F.max("all").alias("all"))
        sure = by_kind.groupBy("pattern").agg(F.sum("n").alias("seeds"), F.max(F.when(F.col("k").isNotNull(), F.struct("n", (-F.col("k")).alias("k")))).alias("top"), F.least(F.sum("mass") / F.max("all"), F.lit(1.0)).alias("conf"))
        sure = kept(sure.where(F.col("seeds") >= SUPPORT).select("pattern", (-F.col("top.k")).cast("int").alias("p_kind"), "conf"), spark, "pii-confidence")
        miss = F.exp(F.sum(F.log(F.greatest(1 - F.col("conf"), F.lit(1e-12)))))
        new = graph.select("value", "pattern").join(sure, "pattern").groupBy("value").agg((1 - miss).alias("score"), (-F.max(F.struct("conf", (-F.col("p_kind")).alias("k")))["k"]).cast("int").alias("k"))
        base = known.where("base")
        new = new.join(base.select("value"), "value", "left_anti").select("value", "k", "score", F.lit(False).alias("base"))
        known = kept(base.union(new), spark, "pii-scores")
    return sure, known


def _apart(toks: Column, base: Column) -> Column:
    """The tokens that no base span touches. Spans of a kind do not overlap, so of many only the last that begins before a token's end is looked at, by halving."""
    few = F.filter(toks, lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    none = F.array(F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("end")))
    kinds = F.array(*[F.concat(none, F.transform(F.filter(base, _of_kind(k)), lambda b: F.struct(b["start"].alias("at"), b["end"].alias("end")))) for k in range(len(KINDS))])
    many = let(kinds, lambda ks: F.filter(toks, lambda t: ~F.exists(ks, lambda spans: last_until(spans, t["end"] - 1)["end"] > t["start"])))
    return F.when(F.size(base) <= FEW, few).otherwise(many)


def find(docs: DataFrame, spark: SparkSession | None = None, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base (spans), more (spans that contexts found): a row for each document."""
    spark = spark or docs.sparkSession
    rows = pick(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    base = rows.select("row", "doc_id", base_spans(F.col("text")).alias("base"), F.when(F.col("text").rlike(_TOKEN), candidates(F.col("text"))).alias("toks"), "text")
    # base spans are the seeds, other identifier-like tokens that no base span touches the candidates
    apart = _apart(F.coalesce("toks", F.array().cast(_PLACES)), F.col("base"))
    unknown = F.transform(apart, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit(None).cast("int").alias("kind"), t["value"].alias("value")))
    marks = let(F.array_sort(F.concat("base", unknown)), lambda ms: _contexts(F.col("text"), ms))
    scan = kept(base.select("row", "doc_id", "base", marks.alias("toks")), spark, "pii-scan")

    empty = F.array().cast(_SPANS)
    each = scan.where(F.size("toks") > 0).select("row", F.explode("toks").alias("t")).select("row", "t.*")
    edges = kept(each.select("row", "start", "end", "value", "kind", F.explode("patterns").alias("pattern")), spark, "pii-edges")
    learned = _learned(edges, pick(docs, "text"), spark, rounds)
    if learned is None:
        return scan.select("doc_id", "base", empty.alias("more"))
    sure, known = learned
    good = sure.where(F.col("conf") >= CONFIDENT)
    new = edges.where("kind IS NULL").join(good, "pattern").join(known.where(F.col("score") >= ACCEPT).select("value"), "value")
    new = new.groupBy("row", "start", "end", "value").agg(F.max(F.struct("conf", (-F.col("p_kind")).alias("k"))).alias("top"))
    # a span within a longer one: one that begins earlier, or as early and is longer, reaches as far
    before = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    new = new.withColumn("reach", F.max("end").over(before)).where("reach IS NULL OR reach < end")
    found = new.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end", (-F.col("top.k")).cast("int").alias("kind"), "value"))).alias("more"))
    return scan.select("row", "doc_id", "base").join(found, "row", "left").select("doc_id", "base", F.coalesce("more", empty).alias("more"))


def report(docs: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more: a row for each document."""
    f = find(docs, spark)
    ordered = lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).when(a["kind"] < b["kind"], -1).when(a["kind"] > b["kind"], 1).otherwise(0)
    counts = [F.size(F.filter("base", _of_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return f.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.array_sort(F.concat("base", "more"), ordered)).alias("spans"), F.size("more").cast("long").alias("n_more"))


def _of_kind(k: int):
    return lambda s: s["kind"] == k


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by <KIND>; of overlapping spans the first counts."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), piece.alias("out"))).otherwise(acc)

    return F.aggregate(spans, zero, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, 1 << 30)))
