"""The stages of the pipeline against plain Python, and what they do with odd tables."""

import random
from collections import Counter

import corpus_pipeline as C
import pytest

from tests.llm.test_models import brute_join, family
from tests.llm.test_native import contamination, targets


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with labels and benchmark; and a text of each item."""
    at = str(tmp_path_factory.mktemp("stages"))
    bench = [(1, " ".join(f"exam{i}" for i in range(30))), (2, "a short item"), (3, None), (4, "")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, bench


def sample(seed):
    rng = random.Random(seed)
    words = lambda n: [rng.choice("bcdfg") + rng.choice("aeiou") + str(rng.randrange(60)) for _ in range(n)]
    texts = [t for n in (4, 12, 40, 90) for t in family(rng, words(n), 8, [0, 0, 1, 2])] + [" ".join(words(40)) for _ in range(30)]
    exam = " ".join(f"EXAM{i}" for i in range(30))
    texts += [" ".join(words(rng.randrange(900))) + " " + exam + ", " + " ".join(words(20)) for _ in range(12)] + ["so A short-item it is", "", None, "  "]
    rng.shuffle(texts)
    return [(i, t, rng.choice(["a", "a", "b", None])) for i, t in enumerate(texts, 10)]


def test_stages_against_loops(spark, documents, tables):
    at, bench = tables
    stage, rows = dict(C.STAGES), sample(4)
    d = documents(rows)
    near = brute_join([r[:2] for r in rows])
    kept = {r.doc_id for r in stage["near_duplicates"](spark, d, at).select("doc_id").collect()}
    assert kept == {i for i, _, low in near if i == low}
    bad = {r[0] for r in contamination([r[:2] for r in rows], bench) if r[-1]}
    clean = {r.doc_id for r in stage["decontamination"](spark, d, at).select("doc_id").collect()}
    assert bad and clean == {i for i, *_ in rows} - bad
    size = {i: len((t or "").split()) for i, t, _ in rows}
    all_, took = Counter(), Counter()
    for i, _, s in rows:
        all_[s] += size[i]
    copies = Counter(r.doc_id for r in stage["mixing"](spark, d, at).select("doc_id").collect())
    for i, _, s in rows:
        took[s] += size[i] * copies[i]
    assert max(copies.values()) <= 2 and all(abs(took[s] - t) <= max(size.values()) for s, t in targets(all_).items())


@pytest.mark.parametrize("name", [n for n, _ in C.STAGES])
def test_odd_tables(spark, documents, clashing, tables, name):
    """Null ids and texts, repeated rows, a long text, clashing names; no rows at all."""
    at, _ = tables
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [(i, f"plain words of text number {i} stand here, so that it counts.", "s") for i in range(60)]
    rows += [(None, None, None), (None, "a text without an id that is long enough", None), (70, None, "s"), (71, "", "s"), (72, long, "t"), (3, rows[3][1], "s"), (3, rows[3][1], "s")]
    d = clashing(documents(rows))
    stage = dict(C.STAGES)[name]
    out = stage(spark, d, at)
    last = name == C.STAGES[-1][0]
    assert out.columns == ([c for c in d.columns if c != "shard"] + ["slot", "shard"] if last else d.columns)
    got = Counter(tuple(r)[:2] for r in out.collect())
    of = Counter(r[:2] for r in rows)
    if name == "near_duplicates":  # one of the repeated rows stays, and rows without words
        assert got == Counter({**of, rows[3][:2]: 1})
    elif name in ("decontamination", "sharding"):
        assert got == of
    elif name == "mixing":
        assert all(got[k] <= 2 * of[k] for k in got) and got[72, long] >= 1
    else:
        assert set(got) <= set(of) and all(got[k] == of[k] for k in got)
    assert stage(spark, d.limit(0), at).count() == 0
