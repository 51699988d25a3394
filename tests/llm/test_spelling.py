"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

from folioscope.llm import spelling


def counted(rows):
    c = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(x.lower() if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    form, out = {}, []
    for w, n in words.items():
        by = sorted((-words[x], x) for x in words if near(w, x))
        form[w] = by[0][1] if by and -by[0][0] >= 5 * n else None
        out.append((w, n, len(by)))
    rows = []
    for w, n, k in out:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, k, words[form[w]] if form[w] else None))
    return sorted(rows)


def run(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def test_words_of_documents(spark, documents, clashing):
    r = random.Random(4)
    base = ["Straße" + x for x in "nnmé"] + ["letters", "leters", "letterss", "Lettérs", "élèves", "éleves", "ÉLÈVES", "aaaaaa", "aaaaaaa", "aaaaaaaa", "short", "x" * 300]
    rows = [(i, "".join(r.choice(base) + r.choice([" ", "-", "×", "1", "\n", "_"]) for _ in range(60))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "letters " * 400), (502, "letters " * 9), (502, "letters " * 9)]
    docs = documents(rows)
    words = counted(rows)
    assert len(words) > 20
    assert {(w, n) for w, n in spelling.vocabulary(docs).collect()} == set(words.items())
    want = brute(words)
    assert run(spelling.spelling_variants(docs, spark)) == want == run(spelling.spelling_variants(clashing(docs), spark))


def test_dense_vocabulary(spark):
    """Few letters, many ties, chains of forms."""
    r = random.Random(7)
    words = {"".join(r.choice("abé") for _ in range(r.randrange(6, 9))): r.choice([5, 5, 7, 25, 26, 130, 700, 3600, 20_000]) for _ in range(700)}
    got = run(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"), spark))
    assert got == brute(words)
    assert any(x[2] not in (x[0], x[1]) for x in got) and any(x[1] is None and x[4] for x in got)


def test_long_chain(spark):
    """Each word's form is the next: roots are found over all steps."""
    words = {"abcdef" + "x" * k: 5 ** (k + 1) for k in range(1, 12)}
    got = {w: root for w, _, root, *_ in run(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long"), spark))}
    assert set(got.values()) == {"abcdef" + "x" * 11}


def test_no_words(spark, documents):
    assert run(spelling.spelling_variants(documents([]), spark)) == []
    assert run(spelling.spelling_variants(documents([(1, "abcdef"), (2, None)]), spark)) == []
