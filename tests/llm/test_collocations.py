"""Collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from folioscope.llm import collocations as co

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOW)):
            ws = re.findall("[^ \t]+", piece)
            n[lang] += len(ws)
            for k in range(1, 6):
                for s in range(len(ws) - k + 1):
                    f[lang, tuple(ws[s : s + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = lambda a, b: any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1))
    out = {}
    for (lang, p), a in cand.items():
        if any(y[0] == lang and len(y[1]) > len(p) and inside(p, y[1]) and 100 * b >= 100 * a for y, b in cand.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    res = []
    for lang, xs in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(xs)[:top], 1):
            res.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(res)


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")


def texts(seed):
    r = random.Random(seed)
    rows = []
    idioms = ["new york city", "of the", "Of The Year award", "é à ü", "b\x0bc d", "per se", "a a a a a a"]
    for _ in range(300):
        ws = [r.choice(idioms) if r.random() < 0.3 else r.choice("abcdefgh") + str(r.randrange(12)) for _ in range(r.randrange(40))]
        rows.append((r.choice(["en", "en", "en", "de", None, ""]), "".join(w + r.choice([" ", "  ", "\t", ", ", ".", " \n", "\r\n"]) for w in ws)))
    return rows + [("en", None), (None, ""), ("fr", " . \n"), ("en", "x y " * 3000)] + [("de", "The same line, again and again")] * 40


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 5, 2000), (2, 20, 7)])
def test_equals_brute_force(spark, seed, least, top):
    rows = texts(seed)
    got = co.collocations(table(spark, rows).repartition(3), spark, least, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, top)
    assert len(want) > 20 and sorted(map(tuple, got.collect())) == want


def test_empty_and_clashing(spark, clashing):
    assert co.collocations(table(spark, []), spark).collect() == []
    assert co.collocations(table(spark, [("en", None)]), spark).collect() == []
    rows = [("en", "one two. three")] * 120
    got = co.collocations(clashing(table(spark, rows)), spark)
    assert [tuple(r) for r in got.collect()] == brute(rows, 100, 2000) == [("en", 1, "one two", 120, 120, 120, 360, 3000)]


def test_products_beyond_64_bits(spark):
    big = 4 * 10**12
    cand = spark.createDataFrame([("en", "a b", big)], co.COUNTS)
    single = spark.createDataFrame([("en", "a", 5 * 10**12), ("en", "b", 7 * 10**12)], co.COUNTS)
    totals = spark.createDataFrame([("en", 9 * 10**14)], "lang string, total long")
    (row,) = co.scored(cand, single, totals).collect()
    assert row["score"] == 1000 * big * 9 * 10**14 // (35 * 10**24)


def test_out_of_core(spark, monkeypatch):
    """Sums over more rows than DuckDB may hold."""
    import duckdb
    import pyarrow as pa

    monkeypatch.setattr(co, "MEMORY", "60MB")
    batches = [pa.RecordBatch.from_pydict({"lang": ["en"] * 20_000, "phrase": [f"some longer phrase {(i * 20_000 + j) % 900_000}" for j in range(20_000)], "n": [1] * 20_000}) for i in range(90)]
    got = pa.Table.from_batches(list(co._duckdb(co._SUM.format("rows"))(iter(batches))))
    assert duckdb.sql("SELECT count(*), min(n), max(n) FROM got").fetchall() == [(900_000, 2, 2)]


def test_bitmap(spark):
    counts = spark.createDataFrame([("en", f"w{i}", 1) for i in range(3000)], co.COUNTS)
    pieces = spark.createDataFrame([("en", f"w{i} w{i + 1} w{i + 2}", 2) for i in range(0, 6000, 10)], "lang string, piece string, n long")
    got = co.counted(pieces, co._PAIRS, co.bitmap_of(counts), 1)
    assert got.count() == 600 and got.where("n <> 2").count() == 0
