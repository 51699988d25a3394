"""Growth rules: phrases followed by a percentage are worth points, adjusted by what the clause says.

``RuleSet.score`` scores one text in plain Python and says what is meant; ``scored`` gives the same for a DataFrame by column expressions
alone, over sorted lists of places: phrases, the percentage after each, and the clause in which that stands. Patterns of phrases are
expressions that both Python and Java read, and match one character at least.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import numbers, places
from folioscope.functions import text as X
from folioscope.functions.text import TABLE_WORDS as _TABLE_WORDS
from folioscope.functions.text import let

# They decide where clauses end and what forces points to be positive.
CLAUSE_ENDS = "。；;"
BOXES = "□☑☒■√✔"
BOX_WORDS = ("适用", "不适用")
YOY = ("同比增长", "同期增长", "同比增幅")
PERCENT = re.compile(r"(\d+(?:\.\d+)?)\s*%")
TABLE_WORDS = re.compile(_TABLE_WORDS)
NARRATIVE = re.compile("[。；！？;!?]")
SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class GrowthRule:
    phrase: str = "复合增长率"
    phrase_aliases: tuple[str, ...] = ()
    phrase_patterns: tuple[str, ...] = ()
    enabled: bool = True
    mode: str = "linear"
    polarity: str = "pos"
    k: float = 0.1
    score_multiplier: float = 1.0
    cap: int = 30
    min_pct: float = 20.0
    window_chars: int = 220
    stop_chars: str = "。！？!?；;"
    company_markers: tuple[str, ...] = ("公司", "本公司", "本集团", "集团公司", "母公司")
    neutralize_if_contains: tuple[str, ...] = ()
    negate_if_contains: tuple[str, ...] = ("成本", "费用")
    full_negate_if_contains: tuple[str, ...] = ()
    negate_penalty_ratio: float = 0.5
    industry_multipliers: tuple[tuple[tuple[str, ...], float], ...] = ()
    thresholds: tuple[tuple[float, int], ...] = ()

    @classmethod
    def of(cls, d: dict) -> GrowthRule:
        """From a configuration: unknown keys are ignored, zeros and blanks that mean "default" are replaced."""
        known = {f for f in cls.__dataclass_fields__}
        own = {k: v for k, v in d.items() if k in known}
        for name in ("phrase_aliases", "phrase_patterns", "company_markers", "neutralize_if_contains", "negate_if_contains", "full_negate_if_contains"):
            if name in own:
                own[name] = tuple(str(x).strip() for x in own[name] if str(x).strip()) if isinstance(own[name], (list, tuple)) else getattr(cls(), name)
        if "industry_multipliers" in own:
            pairs = []
            for m in own["industry_multipliers"] if isinstance(own["industry_multipliers"], list) else []:
                names = m.get("industries", []) if isinstance(m, dict) else []
                pairs.append((tuple([names] if isinstance(names, str) else names), _number(m.get("multiplier", 1.0), 0.0)))
            own["industry_multipliers"] = tuple(pairs)
        if "thresholds" in own:
            own["thresholds"] = tuple(sorted((float(t["ge"]), int(t["score"])) for t in own["thresholds"] if isinstance(t, dict) and {"ge", "score"} <= t.keys()))
        rule = cls(**own)
        positive = lambda v, default: v if (v := _number(v, default)) > 0 else default
        return replace(
            rule, phrase=rule.phrase or cls().phrase, k=_number(rule.k, 0.1) or 0.1, cap=int(_number(rule.cap, 30) or 30), window_chars=int(_number(rule.window_chars, 220) or 220), min_pct=_number(rule.min_pct, 0.0),
            polarity=rule.polarity.strip().lower() if str(rule.polarity).strip().lower() in ("pos", "neg") else "pos", score_multiplier=positive(rule.score_multiplier, 1.0), negate_penalty_ratio=positive(rule.negate_penalty_ratio, 0.5), mode=(rule.mode or "linear").lower(), stop_chars=rule.stop_chars or cls().stop_chars,
        )

    def matchers(self) -> list[tuple[re.Pattern, str | None]]:
        """(pattern, its fixed label or None if the label is the matched text), without repeats; bad patterns are left out."""
        out: dict[str, tuple[re.Pattern, str | None]] = {}
        for p in (self.phrase, *self.phrase_aliases):
            out.setdefault(p, (re.compile(re.escape(p)), p))
        for p in self.phrase_patterns:
            try:
                out.setdefault("re:" + p, (re.compile(p), None))
            except re.error:
                continue
        return list(out.values())

    def multiplier(self, industries: Iterable[str]) -> float:
        """The rule's multiplier times the smallest of those whose industry fits (equal, or one contains the other)."""
        have = [s for x in industries if (s := str(x).strip())]
        fits = [m for names, m in self.industry_multipliers if m > 0 and any(n and (n in h or h in n) for n in map(str.strip, map(str, names)) for h in have)]
        return self.score_multiplier * min([1.0, *fits])

    def base(self, value: float) -> tuple[int, str] | None:
        """Points of a percentage before any multiplier and the end of its label; None if it does not count."""
        if self.mode == "thresholds":
            reached = [(ge, s) for ge, s in self.thresholds if value >= ge]
            if not reached or reached[-1][1] <= 0:
                return None
            ge, s = reached[-1]
            return s, f">={int(ge) if ge == int(ge) else ge}%"
        pts = min(int(value * self.k), self.cap)
        return (pts, f"={value:g}%") if value >= self.min_pct and int(value * self.k) > 0 else None

    def adjusted(self, phrase: str, clause: str, base: int, multiplier: float) -> int:
        """Points with what the clause says: the company itself, then neutral, then discounted, then full negation."""
        pts = max(1, math.ceil(abs(base) * multiplier)) * (-1 if self.polarity == "neg" else 1)
        bare = SPACE.sub("", clause)
        says = lambda words: bool(bare) and any(w in bare for w in words)
        if any(y in phrase for y in YOY) and says(self.company_markers):
            return abs(base)
        if says(self.neutralize_if_contains):
            return 0
        if says(self.full_negate_if_contains):
            return -abs(base)
        if says(self.negate_if_contains):
            return -max(1, int(abs(pts) * self.negate_penalty_ratio))
        return pts


def _number(v, default: float) -> float:
    try:
        return float(v)
    except (TypeError, ValueError):
        return default


def clause_at(text: str, at: int, most: int = 800) -> str:
    """The clause around a place, between sentence marks and checkbox words, white space collapsed.

    The left end is one character after a mark's first, also for marks of several characters.
    """
    ends = [*CLAUSE_ENDS, *(b + w for b in BOXES for w in BOX_WORDS)]
    left = max([0, *(p + 1 for e in ends if (p := text.rfind(e, 0, at)) >= 0)])
    right = min([len(text), *(p for e in ends if (p := text.find(e, at)) >= 0)])
    s = SPACE.sub(" ", text[left:right]).strip()
    if len(s) > most:
        first = max(0, max(0, min(len(s) - 1, at - left)) - most // 2)
        last = min(len(s), first + most)
        first = max(0, last - most)
        s = ("…" if first else "") + (s[first:last].strip().rstrip() + "…" if last < len(s) else s[first:last].strip())
    return s


def trimmed(clause: str) -> str:
    """The clause after its last "不适用" and before the first box or applicability word that is left."""
    at = clause.rfind(BOX_WORDS[1])
    s = clause[at + len(BOX_WORDS[1]) :].strip() if at >= 0 else clause
    cuts = [p for w in [*(b + w for b in BOXES for w in BOX_WORDS), *BOX_WORDS] if (p := s.find(w)) >= 0]
    return s[: min(cuts)].strip() if cuts else s


def is_table(text: str) -> bool:
    t = SPACE.sub(" ", text).strip()
    n, prose = len(t), bool(NARRATIVE.search(t))
    digits = sum(c.isdigit() for c in t)
    loose = not prose and ((t.count(",") + t.count("，") >= 14 and n >= 260) or (n >= 420 and digits / n > 0.26) or (t.count("%") >= 5 and n >= 260))
    return bool(t) and (bool(TABLE_WORDS.search(t)) or (t.count("|") >= 2 and n >= 140) or loose)


def window_at(text: str, at: int, window: int) -> str:
    half = max(20, window // 2)
    a, b = max(0, at - half), min(len(text), at + half)
    return ("…" if a else "") + SPACE.sub(" ", text[a:b]).strip() + ("…" if b < len(text) else "")


@dataclass
class Hit:
    keyword: str
    weight: int
    count: int = 1
    polarity: str = "pos"
    context: str | None = None


@dataclass(frozen=True)
class RuleSet:
    rules: tuple[GrowthRule, ...] = field(default_factory=lambda: (GrowthRule(),))

    @classmethod
    def from_json(cls, text: str) -> RuleSet:
        """A list ``cagr_rules``, else a single ``cagr_rule``, else the default rule; each over the default's values."""
        d = json.loads(text) if text.strip() else {}
        many, one = d.get("cagr_rules"), d.get("cagr_rule")
        chosen = many if isinstance(many, list) and many else [one] if isinstance(one, dict) else [{}]
        return cls(tuple(GrowthRule.of(r) for r in chosen if isinstance(r, dict)))

    def mentions(self, text: str, industries: Iterable[str] = ()) -> Iterator[tuple[int, str, int, str]]:
        """(rule, label, points, clause) of each mention that counts, in order; of equal label and clause the first."""
        industries, seen = list(industries), set()
        for i, rule in enumerate(r for r in self.rules if r.enabled):
            stop = re.compile("[" + re.escape(rule.stop_chars.replace(",", "").replace("，", "")) + "]")
            factor = rule.multiplier(industries)
            for pattern, label in rule.matchers():
                for m in pattern.finditer(text):
                    ahead = stop.split(text[m.end() : m.end() + rule.window_chars], 1)[0]
                    found = PERCENT.search(ahead)
                    scored = rule.base(float(found[1])) if found else None
                    if not scored:
                        continue
                    at = m.end() + found.start()
                    clause = trimmed(clause_at(text, at))
                    if len(clause) > 600 and is_table(clause):
                        clause = window_at(text, at, 260)
                    phrase = label or m[0]
                    key = (phrase + scored[1], SPACE.sub(" ", clause).strip())
                    if key not in seen:
                        seen.add(key)
                        yield i, key[0], rule.adjusted(phrase, clause, scored[0], factor), clause

    def score(self, text: str | None, industries: Iterable[str] = ()) -> tuple[int, list[Hit]]:
        """Total points, and hits by rule and label: strongest weight (the first of equal ones), negative if any is."""
        total, hits = 0, {}
        for rule, label, pts, clause in self.mentions(text or "", industries):
            total += pts
            h = hits.get((rule, label))
            if h is None:
                hits[rule, label] = Hit(label, pts, 1, "neg" if pts < 0 else "pos", clause or None)
                continue
            h.count += 1
            if abs(pts) > abs(h.weight):
                h.weight = pts
            if pts < 0:
                h.polarity = "neg"
            h.context = h.context or clause or None
        return total, list(hits.values())


# ---- the same over columns ----------------------------------------------------------------------------------------

_SEPARATORS = f"[{CLAUSE_ENDS}]|[{BOXES}](?=适用|不适用)"
_PERCENT = r"(?U)(\d+(?:\.\d+)?)\s*%"
_FULL_WIDTH, _DIGITS = "０１２３４５６７８９", "0123456789"
_BLOCK = 1024
#: Bytes of distinct texts that may be broadcast with their mentions (counted before), and what a row of them takes besides.
MAX_BROADCAST, _ROW_BYTES = 4 << 20, 64
_HITS = "array<struct<keyword:string,weight:int,count:int,polarity:string,context:string>>"


def _quoted(phrase: str) -> str:
    return "\\Q" + phrase.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _says(bare: Column, words: Iterable[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(bare, F.lit(w))
    return out


def _short(v: Column) -> Column:
    """A number with six significant digits and no needless zeros."""
    digits = F.format_string("%.9f", v)
    for least, form in ((0.1, "%.6f"), (1, "%.5f"), (10, "%.4f"), (100, "%.3f"), (1000, "%.2f"), (10_000, "%.1f"), (100_000, "%.0f")):
        digits = F.when(v >= least, F.format_string(form, v)).otherwise(digits)
    plain = F.regexp_replace(F.regexp_replace(digits, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    power = F.regexp_replace(F.regexp_replace(F.format_string("%.5e", v), r"(\.\d*?)0+e", "$1e"), r"\.e", "e")
    return F.when(v >= 999_999.5, power).otherwise(plain)


def _base(rule: GrowthRule, v: Column) -> tuple[Column, Column]:
    """Points of a percentage before any multiplier (null: it does not count) and the end of its label."""
    if rule.mode != "thresholds":
        pts = F.when(v >= rule.min_pct, F.floor(v * rule.k))
        return F.when(pts > 0, F.least(pts, F.lit(rule.cap))).cast("int"), F.concat(F.lit("="), _short(v), F.lit("%"))
    pts, label = F.lit(None).cast("int"), F.lit("")
    for ge, score in rule.thresholds:
        pts, label = F.when(v >= ge, F.lit(score)).otherwise(pts), F.when(v >= ge, F.lit(f">={int(ge) if ge == int(ge) else ge}%")).otherwise(label)
    return F.when(pts > 0, pts), label


def _adjusted(rule: GrowthRule, phrase: Column, clause: Column, base: Column, multiplier: Column) -> Column:
    sign = -1 if rule.polarity == "neg" else 1
    pts = F.greatest(F.lit(1), F.ceil(base * multiplier).cast("int")) * sign
    judged = lambda bare: (
        F.when(_says(phrase, YOY) & _says(bare, rule.company_markers), base)
        .when(_says(bare, rule.neutralize_if_contains), 0)
        .when(_says(bare, rule.full_negate_if_contains), -base)
        .when(_says(bare, rule.negate_if_contains), -F.greatest(F.lit(1), F.floor(F.abs(pts) * rule.negate_penalty_ratio).cast("int")))
        .otherwise(pts)
    )
    return let(X.no_space(clause), judged)


def _clause(text: Column, clause: Column, at: Column, most: int = 800) -> Column:
    """What a mention's clause (at, said) says: at most so many characters around the place, what is not applicable left out, a table cut short."""
    s, n = clause["said"], F.length(clause["said"])
    first = F.greatest(F.lit(0), F.greatest(F.lit(0), F.least(n - 1, at - clause["at"])) - most // 2)
    last = F.least(n, first + most)
    first = F.greatest(F.lit(0), last - most)
    some = F.concat(F.when(first > 0, "…").otherwise(""), F.trim(F.substring(s, first + 1, last - first)), F.when(last < n, "…").otherwise(""))
    after = F.trim(F.substring_index(F.when(n > most, some).otherwise(s), BOX_WORDS[1], -1))
    applies = f"[{BOXES}]?{BOX_WORDS[0]}"
    before = let(after, lambda x: F.when(F.contains(x, F.lit(BOX_WORDS[0])), F.trim(F.get(F.split(x, applies, 2), F.lit(0)))).otherwise(x))
    return let(before, lambda x: F.when((F.length(x) > 600) & X.table_noise(x), X.window_around(text, at, 260)).otherwise(x))


def mentions(text: Column, rules: RuleSet, industries: Column) -> Column:
    """array<struct<no, rule, label, points, clause, kind>>: what ``RuleSet.mentions`` gives, by lists of places. kind: the number of the phrase.

    Places of phrases come from one pass for each phrase; the text after one is cut out of blocks of the text; the clause of a percentage is found by
    halving in the sorted list of clauses; of equal labels and clauses the first is kept by a sort.
    """
    active = [r for r in rules.rules if r.enabled]
    said = lambda p: F.when(F.contains(p, F.lit("%")), X.one_space(p)).otherwise("")  # noqa: E731  others hold no percentage
    clauses = F.transform(places.parts(text, _SEPARATORS), lambda c: F.struct(c["at"].alias("at"), said(c["part"]).alias("said")))
    blocks = F.when(F.length(text) <= _BLOCK, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)))

    def of(kind: int, rule: GrowthRule, number: int, pattern: str, label: str | None, clauses: Column, blocks: Column) -> Column:
        stops = "^[^" + re.escape(rule.stop_chars.replace(",", "").replace("，", "")) + "]*"
        some = rule.window_chars // _BLOCK + 2

        def ahead(m: Column) -> Column:
            near = F.array_join(F.slice(blocks, F.floor(m["end"] / _BLOCK).cast("int") + 1, some), "")
            return F.regexp_extract(F.substring(near, m["end"] % _BLOCK + 1, F.lit(rule.window_chars)), stops, 0)

        def found(m: Column) -> Column:
            value = lambda a: F.nullif(F.translate(F.regexp_extract(a, _PERCENT, 1), _FULL_WIDTH, _DIGITS), F.lit("")).try_cast("double")
            return let(ahead(m), lambda a: F.struct((F.lit(label) if label else m["found"]).alias("phrase"), value(a).alias("v"), (m["end"] + F.length(F.regexp_extract(a, rf"(?s)^(.*?){_PERCENT}", 1))).cast("int").alias("at")))

        def judged(x: Column) -> Column:
            base, tail = _base(rule, x["v"])
            factor = F.lit(float(rule.score_multiplier)) * numbers.industry_multiplier(industries, list(rule.industry_multipliers))
            clause = lambda c: let(_clause(text, c, x["at"]), lambda s: F.struct(F.lit(number).alias("rule"), F.concat(x["phrase"], tail).alias("label"), _adjusted(rule, x["phrase"], s, base, factor).alias("points"), s.alias("clause"), F.lit(kind).alias("kind")))
            return let(places.last_until(clauses, x["at"]), clause)

        counted = F.filter(F.transform(places.matches(text, pattern), found), lambda x: x["v"].isNotNull() & _base(rule, x["v"])[0].isNotNull())
        here = F.contains(text, F.lit(label)) if label else text.rlike(pattern)
        return F.transform(F.when(here, counted).otherwise(F.filter(F.array(found(F.struct(F.lit(0).alias("end"), F.lit("").alias("found")))), lambda x: F.lit(False))), judged)

    kinds = [(i, r, _quoted(label) if label else p.pattern, label) for i, r in enumerate(active) for p, label in r.matchers()]
    if not kinds:
        return F.array().cast("array<struct<no:int,rule:int,label:string,points:int,clause:string,kind:int>>")
    each = lambda cs: let(blocks, lambda bs: F.concat(*[of(k, r, i, p, label, cs, bs) for k, (i, r, p, label) in enumerate(kinds)]))
    rows = F.transform(let(clauses, each), lambda x, i: F.struct(i.alias("no"), x["rule"].alias("rule"), x["label"].alias("label"), x["points"].alias("points"), x["clause"].alias("clause"), x["kind"].alias("kind")))
    keyed = lambda rs: F.sort_array(F.transform(rs, lambda r: F.struct(r["label"].alias("label"), X.one_space(r["clause"]).alias("key"), r["no"].alias("no"), r.alias("r"))))
    same = lambda a, b: (a["label"] == b["label"]) & (a["key"] == b["key"])
    firsts = lambda ks: F.filter(ks, lambda k, i: (i == 0) | ~same(k, F.get(ks, i - 1)))
    return let(rows, lambda rs: F.when(F.size(rs) > 1, F.sort_array(F.transform(let(keyed(rs), firsts), lambda k: k["r"]))).otherwise(rs))


def _hits(found: Column) -> Column:
    """Mentions by rule and label, in the order of their first ones."""
    by_label = F.sort_array(F.transform(found, lambda x: F.struct(x["rule"].alias("rule"), x["label"].alias("label"), x["no"].alias("no"), x["points"].alias("points"), x["clause"].alias("clause"))))

    def hit(g: Column) -> Column:
        strongest = F.aggregate(g, F.lit(0), lambda a, x: F.when(F.abs(x["points"]) > F.abs(a), x["points"]).otherwise(a))
        context = F.get(F.filter(g, lambda x: x["clause"] != ""), F.lit(0))["clause"]
        first = F.get(g, F.lit(0))
        kind = F.when(F.exists(g, lambda x: x["points"] < 0), "neg").otherwise("pos")
        return F.struct(first["no"].alias("no"), F.struct(first["label"].alias("keyword"), strongest.alias("weight"), F.size(g).alias("count"), kind.alias("polarity"), context.alias("context")).alias("hit"))

    def grouped(xs: Column) -> Column:
        new = lambda i: (i == 0) | (F.get(xs, i)["rule"] != F.get(xs, i - 1)["rule"]) | (F.get(xs, i)["label"] != F.get(xs, i - 1)["label"])
        starts = F.filter(F.transform(xs, lambda x, i: i), new)
        groups = let(starts, lambda at: F.transform(at, lambda a, k: hit(F.slice(xs, a + 1, F.coalesce(F.get(at, k + 1), F.size(xs)) - a))))
        return F.transform(F.sort_array(groups), lambda h: h["hit"])

    one = F.get(found, F.lit(0))
    alone = F.array(F.struct(one["label"].alias("keyword"), one["points"].alias("weight"), F.lit(1).alias("count"), F.when(one["points"] < 0, "neg").otherwise("pos").alias("polarity"), F.when(one["clause"] != "", one["clause"]).alias("context")))
    return F.when(F.size(found) == 0, F.array().cast(_HITS)).when(F.size(found) == 1, alone.cast(_HITS)).otherwise(let(by_label, grouped).cast(_HITS))


def scored(df: DataFrame, text: str, rules: RuleSet, industries: str | None = None, repeats: bool = False) -> DataFrame:
    """df with growth_total and growth_hits of each row's text (industries: a column of array<string>), by column expressions alone.

    repeats: equal texts are frequent, so distinct ones are scored, after partial aggregation, and joined to the rows.
    """
    cols = df.columns
    rows = df.withColumns({"__t": F.coalesce(F.col(text), F.lit("")), "__n": F.col(industries) if industries else F.array().cast("array<string>")})
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x["points"])
    result = let(mentions(F.col("__t"), rules, F.col("__n")), lambda xs: F.struct(total(xs).alias("total"), _hits(xs).alias("hits")))
    if repeats:
        once = rows.select("__t", "__n").distinct().select(F.col("__t").alias("__u"), F.col("__n").alias("__m"), result.alias("__g"))
        rows = rows.join(once, (F.col("__t") == F.col("__u")) & F.col("__n").eqNullSafe(F.col("__m")))
    else:
        rows = rows.withColumn("__g", result)
    return rows.select(*cols, F.col("__g.total").alias("growth_total"), F.col("__g.hits").alias("growth_hits"))


def scored_rows(df: DataFrame, key: str, text: str, rules: RuleSet, order: str | None = None) -> DataFrame:
    """key, growth_total and growth_hits of documents whose texts stand in rows (of equal key, in the order of ``order``, else of the text).

    As ``scored`` of a document's rows joined, if each ends a clause at a mark that is a stop of all rules, so no mention reaches into the next. Distinct
    texts are judged once; the rest is joins and groups by document, after one shuffle. Documents without mentions are left out.
    """
    rows = df.select(F.col(key).alias("__k"), F.col(text).alias("__t"), F.col(order or text).alias("__o"))
    once = rows.select(F.col("__t").alias("__u")).distinct()
    few = once.agg(F.coalesce(F.sum(F.octet_length("__u") + _ROW_BYTES), F.lit(0))).first()[0] <= MAX_BROADCAST
    found = once.select("__u", mentions(F.col("__u"), rules, F.array().cast("array<string>")).alias("__f"))
    keyed = lambda x: F.struct(x["label"].alias("label"), X.one_space(x["clause"]).alias("key"), *[x[c].alias(c) for c in ("kind", "no", "rule", "points", "clause")])
    found = found.select("__u", F.transform("__f", keyed).alias("__f"))
    same = F.col("__t") == F.col("__u")
    # few texts go to the rows, which then stay with their documents
    said = rows.repartition("__k").join(F.broadcast(found), same) if few else rows.join(found, same).repartition("__k")
    # inline() would infer a filter by its mentions, which Spark pushes below distinct() to all rows
    said = said.select("__k", "__o", F.inline_outer("__f")).where(F.col("label").isNotNull())
    place = lambda *more: F.struct("kind", "__o", "no", *more)
    first = said.groupBy("__k", "label", "key").agg(F.min(place("rule", "points", "clause")).alias("m")).select("__k", "label", "m.*")
    hit = first.groupBy("__k", "rule", "label").agg(
        F.min(place()).alias("at"),
        F.sum("points").alias("total"),
        F.min(F.struct((-F.abs("points")).alias("size"), place().alias("at"), "points"))["points"].alias("weight"),
        F.count(F.lit(1)).cast("int").alias("count"),
        F.when(F.min("points") < 0, "neg").otherwise("pos").alias("polarity"),
        F.min(F.when(F.col("clause") != "", place("clause")))["clause"].alias("context"),
    )
    hits = F.sort_array(F.collect_list(F.struct("at", F.struct(F.col("label").alias("keyword"), "weight", "count", "polarity", "context").alias("hit"))))
    out = hit.groupBy("__k").agg(F.sum("total").alias("growth_total"), F.transform(hits, lambda h: h["hit"]).cast(_HITS).alias("growth_hits"))
    return out.withColumnRenamed("__k", key)
