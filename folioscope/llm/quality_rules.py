"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

1. Statistics: a dozen numbers of each whole text, all built-in column expressions.
2. Trees: small regression trees are grown one after another on the residuals of a bounded sample of
   labelled rows (SAMPLE rows by hash; the rows to hold out never enter). Every path from a root to
   a node is a rule: a conjunction of comparisons of statistics with constants.
3. Lasso: a logistic regression with an L1 penalty over the rules' 0/1 columns, by accelerated
   proximal gradient steps; most weights become exactly 0. The penalty is chosen on a part of the sample.
4. The remaining rules are compiled to one column expression, so scoring is one scan without Python.

Labels, language, source and doc_id are never inputs of a score.

Defined results: null and empty texts are scored like a text without characters; null labels are
left out; without labels of both classes the score is the smoothed share of label 1 (0.5 without any);
repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm._shared import let, pick

#: Labelled rows to fit on at most, the lowest by hash. Scores cover all documents.
SAMPLE = 20_000
THRESHOLD, FOLDS = 0.3, 5
TREES, DEPTH, BINS = 40, 3, 32


def statistics(text: Column) -> dict[str, Column]:
    """Name -> statistic of the whole text."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    share = lambda c: c / F.greatest(n, F.lit(1))
    count = lambda p: F.regexp_count(t, F.lit(p))
    less = lambda x: n - F.length(F.replace(t, F.lit(x), F.lit("")))
    words = F.greatest(count(r"\S+"), F.lit(1))
    lines = less("\n") + 1
    return {
        "log_chars": F.log1p(n.cast("double")),
        "word_chars": n / words,
        "upper": share(count(r"\p{Lu}")),
        "digits": share(count(r"\d")),
        "marks": share(count(r"[#$%&*@=<>^~\\{}\[\]_]")),
        "bangs": share(less("!")),
        "pipes": share(less("|")),
        "stops": (less(".") + less("?")) / words,
        "commas": less(",") / words,
        "line_words": words / lines,
        "lines_again": 1 - F.size(F.array_distinct(F.split(t, "\n"))) / lines,
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is above, constant), and its weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, cut in self.terms:
            v = x[:, names.index(name)]
            out &= v > cut if above else v <= cut
        return out

    def column(self, stats: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, above, cut in self.terms:
            out = out & ((stats[name] > cut) if above else (stats[name] <= cut))
        return out


@dataclass(frozen=True)
class Model:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the rules that hold)))."""

    bias: float
    rules: tuple[Rule, ...]

    def predict(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for r in self.rules:
            z += r.weight * r.holds(x, names)
        return 1 / (1 + np.exp(-z))

    def column(self, stats: dict[str, Column]) -> Column:
        z = F.lit(float(self.bias))
        for r in self.rules:
            z = z + F.when(r.column(stats), float(r.weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def _grow(x: np.ndarray, y: np.ndarray, names: list[str], cuts: list[np.ndarray], depth: int, terms: tuple, least: int, out: list, fit: np.ndarray, rows: np.ndarray) -> None:
    """Adds the rules of all nodes below; writes the leaves' means to fit."""
    fit[rows] = y[rows].mean() if len(rows) else 0.0
    if depth == 0 or len(rows) < 2 * least:
        return
    best = (1e-9, -1, 0.0)
    total, n = y[rows].sum(), len(rows)
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        k = np.searchsorted(c, x[rows, j], side="left")  # v <= c[i] for all i >= k
        num = np.bincount(k, minlength=len(c) + 1).cumsum()[:-1]
        s = np.bincount(k, weights=y[rows], minlength=len(c) + 1).cumsum()[:-1]
        ok = (num >= least) & (n - num >= least)
        if ok.any():
            gain = np.where(ok, s**2 / np.maximum(num, 1) + (total - s) ** 2 / np.maximum(n - num, 1) - total**2 / n, -1)
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), j, float(c[i]))
    _, j, cut = best
    if j < 0:
        return
    for above in (False, True):
        side = rows[(x[rows, j] > cut) == above]
        more = (*terms, (names[j], above, cut))
        out.append(more)
        _grow(x, y, names, cuts, depth - 1, more, least, out, fit, side)


def _simplified(terms: tuple) -> tuple:
    """The same conjunction with one bound on each side of each statistic, in a fixed order."""
    low, high = {}, {}
    for name, above, cut in terms:
        if above:
            low[name] = max(cut, low.get(name, -np.inf))
        else:
            high[name] = min(cut, high.get(name, np.inf))
    return tuple(sorted([(n, True, c) for n, c in low.items()] + [(n, False, c) for n, c in high.items()]))


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the mean logistic loss + penalty * sum of |weight|."""
    n, k = r.shape
    w, b = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    rate = 1 / (0.25 * max(1e-9, np.linalg.norm(np.c_[r, np.ones(n)], 2) ** 2 / n))
    v, c, t = w.copy(), b, 1.0
    for _ in range(steps):
        e = 1 / (1 + np.exp(-(r @ v + c))) - y
        w2 = v - rate * (r.T @ e / n)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * penalty, 0)
        b2 = c - rate * e.mean()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return float(b), w


def fit(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 7) -> Model:
    """The model for statistics x (a column for each name) and labels y (0 or 1)."""
    if len(y) < 20 or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        return Model(float(np.log(p / (1 - p))), ())
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    z, paths = np.full(len(y), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), []
    for _ in range(TREES):
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        step = np.zeros(len(y))
        res = y - 1 / (1 + np.exp(-z))
        found: list = []
        leaf = np.zeros(len(y))
        _grow(x, res, names, cuts, DEPTH, (), max(5, len(y) // 400), found, leaf, rows)
        step[rows] = leaf[rows]
        z += 1.0 * step
        paths += found
    unique = list(dict.fromkeys(_simplified(p) for p in paths))
    cols, rules, seen = [], [], set()
    for p in unique:
        h = Rule(p).holds(x, names)
        if 0.002 < h.mean() < 0.998 and (key := np.packbits(h).tobytes()) not in seen:
            seen.add(key)
            cols.append(h)
            rules.append(p)
    if not rules:
        return fit(x[:0], y[:0], names)
    r = np.stack(cols, 1).astype(np.float64)
    train = rng.random(len(y)) < 0.75
    best = None
    for penalty in (0.02, 0.008, 0.003, 0.001):
        b, w = lasso_logistic(r[train], y[train], penalty, 200)
        p = np.clip(1 / (1 + np.exp(-(r[~train] @ w + b))), 1e-6, 1 - 1e-6)
        loss = -(y[~train] * np.log(p) + (1 - y[~train]) * np.log(1 - p)).mean() if (~train).any() else 0.0
        if best is None or loss < best[0] - 1e-4:
            best = (loss, penalty)
    b, w = lasso_logistic(r, y, best[1])
    return Model(b, tuple(Rule(p, float(v)) for p, v in zip(rules, w, strict=True) if abs(v) > 1e-6))


def held_out(doc_id: Column) -> Column:
    """Whether the row is kept from fitting: crc32 of the id as text, modulo FOLDS, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` labelled rows, none of them held out."""
    own = pick(labels, "doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    few = own.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample).withColumnRenamed("doc_id", "label_id")
    stats = statistics(F.col("text"))
    rows = pick(docs, "doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("label_id"))  # broadcast: at most ``sample`` ids
    got = rows.select(F.col("quality").cast("double").alias("y"), F.xxhash64("doc_id", "text").alias("o"), *[c.alias(n) for n, c in stats.items()]).orderBy("o", "y").limit(sample).collect()
    x = np.array([r[2:] for r in got], dtype=np.float64).reshape(len(got), len(stats))
    return fit(x, np.array([r[0] for r in got]), list(stats))


def score_of(text: Column, model: Model) -> Column:
    """The model's score; the statistics are computed once for all rules."""
    stats = statistics(text)
    return let(F.struct(*[c.alias(n) for n, c in stats.items()]), lambda s: model.column({n: s[n] for n in stats}))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each document."""
    rows = pick(docs, "doc_id", "text")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_of(F.col("text"), model).alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, spark: SparkSession | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows whose score is below threshold."""
    model = train(docs, labels)
    cols = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    return rows.where(score_of(F.col(f"c{cols.index('text')}"), model) >= threshold).toDF(*cols)
