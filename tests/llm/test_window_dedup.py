"""Substring dedup against brute force."""

import random

import numpy as np
import pytest

from folioscope.llm import window_dedup as wd


def brute(rows):
    """(doc_id, n_words, n_removed, kept words) of (doc_id, text) rows."""
    docs = [((wd.LAST if i is None else i), i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for d, _, ws in docs:
        for s in range(len(ws) - 19):
            g = tuple(ws[s : s + 20])
            first[g] = min(first.get(g, (d, s)), (d, s))
    out = []
    for d, i, ws in docs:
        gone = {p for s in range(len(ws) - 19) if first[tuple(ws[s : s + 20])] < (d, s) for p in range(s, s + 20)}
        out.append((i, len(ws), len(gone), b" ".join(w for p, w in enumerate(ws) if p not in gone).decode()))
    return sorted(out, key=repr)


def run(spark, df):
    return sorted(map(tuple, wd.without_repeats(df, spark).collect()), key=repr)


def mixed(seed):
    """Texts of few words with copies, near copies, shared passages and a line that most of them have."""
    r = random.Random(seed)
    word = lambda n: "w%d" % r.randrange(n)
    line = [word(500) for _ in range(24)]
    passages = [[word(900) for _ in range(r.randrange(15, 60))] for _ in range(4)]
    rows = []
    for i in range(160):
        ws = [word(2 if i % 40 == 0 else 1500) for _ in range(r.randrange(0, 120))]
        if r.random() < 0.6:
            ws += line + [word(1500) for _ in range(r.randrange(25))]
        if r.random() < 0.5:
            at = r.randrange(len(ws) + 1)
            ws[at:at] = r.choice(passages)
        rows.append((i, r.choice([" ", "\n", " \t "]).join(ws)))
    for i in range(160, 200):
        ws = rows[r.randrange(160)][1].split()
        if ws and i % 2:
            ws[r.randrange(len(ws))] = "changed"
        rows.append((i, " ".join(ws)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (None, rows[3][1]), (None, rows[5][1] + " x"), rows[7], (7, "other " + rows[8][1]), (204, "a " * 700), (205, "a " * 333 + "b")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(("chunk", "codes", "broadcast"), [(4 << 20, 65_535, 10**6), (500, 40, 0)])
def test_equals_brute_force(spark, documents, seed, chunk, codes, broadcast, monkeypatch):
    monkeypatch.setattr(wd, "CHUNK", chunk)
    monkeypatch.setattr(wd, "CODES", codes)
    monkeypatch.setattr(wd, "MAX_BROADCAST", broadcast)
    rows = mixed(seed)
    assert run(spark, documents(rows).repartition(3)) == brute(rows)


def test_blanks_that_are_no_blanks(spark, documents):
    text = " ".join(f"x{i}" for i in range(30)) + "  y\x1cz \x85"
    rows = [(1, text), (2, " ".join(f"é{i}" for i in range(25))), (3, "\x0b".join(f"é{i}" for i in range(25)))]
    assert run(spark, documents(rows)) == brute(rows)
    assert brute(rows)[2][2] == 25


def test_empty_and_clashing(spark, documents, clashing):
    assert run(spark, documents([])) == []
    rows = [(1, "a b c " * 12), (2, "a b c " * 12)]
    assert run(spark, clashing(documents(rows))) == brute(rows)


def test_hot_line_is_spread(spark, documents):
    """A line that all texts have: its bucket holds few strings, although the words around it differ."""
    r = random.Random(3)
    line = " ".join(f"l{i}" for i in range(8))
    rows = [(i, " ".join(f"v{r.randrange(10**6)}" for _ in range(15)) + f" {line} " + " ".join(f"v{r.randrange(10**6)}" for _ in range(15))) for i in range(600)]
    keyed = wd._keyed(documents(rows))
    frequent, coded = wd.statistics(keyed, 1 / 4096, spark)
    assert len(frequent) == 9 - wd.SEED
    most = lambda f: wd._sent(keyed, f, coded).groupBy("bucket").count().agg({"count": "max"}).first()[0]
    assert most(frequent) <= 2 < 100 < most(np.zeros(0, np.uint64))
    assert run(spark, documents(rows)) == brute(rows)


def test_long_text(spark, documents):
    r = random.Random(5)
    half = " ".join(f"w{r.randrange(3000)}" for _ in range(150_000))
    (a, n, removed, text) = wd.without_repeats(documents([(1, half + " " + half)]), spark).first()
    assert (a, n, removed, text) == (1, 300_000, 150_000, half)
