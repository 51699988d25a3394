"""Top-k search, the n-gram join, the quality rules, url filters, the token store and the pipeline."""

import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import ngram_join as J
from folioscope.llm import quality_rules as Q
from folioscope.llm import token_store as T
from folioscope.llm import topk as K
from folioscope.llm import url_filter as U

# ---- top-k --------------------------------------------------------------------------------------------------------


def brute_top(rows, k, every):
    ok = []
    for i, (vid, v) in enumerate(rows):
        if vid is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.append((i, vid, [math.floor(64 * x) for x in v]))
    out = []
    for i, vid, q in ok:
        if vid % every == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), w, j) for j, w, v in ok if j != i)[:k]
            out += [(vid, n + 1, w, -t) for n, (t, w, _) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("shape", ["clusters", "one vector", "plain"])
def test_top_k(spark, clashing, shape, monkeypatch):
    monkeypatch.setattr(K, "LEAF", 8)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(5, 6)) * 3
    make = {"clusters": lambda i: centre[i % 5] + rng.normal(size=6) * 0.05, "one vector": lambda i: centre[0] if i % 3 else rng.normal(size=6), "plain": lambda i: rng.normal(size=6)}[shape]
    rows = [(i, [float(np.float32(x)) for x in make(i)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, []), (405, [1.0]), (20, rows[7][1]), (20, rows[20][1]), (None, rows[0][1])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted(map(tuple, K.top_k(df, k=7, every=20, pivots=4, block=60, queries=6).collect()))
    assert got == brute_top(rows, 7, 20)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, K.top_k(df).collect())) == [(0, 1, 1, 8192), (0, 2, 2, 8192)]
    assert K.top_k(df.limit(0)).count() == 0 and K.top_k(df.where("vec_id = 0")).count() == 0
    big = spark.createDataFrame([(0, [3e7, 1.0]), (1, [2e7, -1.0])], "vec_id long, embedding array<float>")
    assert [r.score for r in K.top_k(big).collect()] == [int(3e7 * 64) * int(2e7 * 64) - 64 * 64]


def below(node):
    return node.rows if not node.children else np.concatenate([below(c) for c in node.children])


@pytest.mark.parametrize("shape", ["plain", "repeated", "one"])
def test_cover_tree(shape):
    rng = np.random.default_rng(0)
    x = {"plain": rng.integers(-90, 90, (700, 5)), "repeated": rng.integers(-1, 2, (700, 2)), "one": np.ones((30, 3))}[shape].astype(float)
    tree = K.cover_tree(x, 90)
    tree = K.unpacked(x, K.packed(tree, len(x)))
    levels = {}

    def check(node):
        assert sorted(below(node)) == sorted(set(below(node)))
        assert math.isclose(node.radius, np.sqrt(((x[below(node)] - node.centre) ** 2).sum(1)).max(), abs_tol=1e-9)
        levels.setdefault(node.level, set()).add(node.point)
        for c in node.children:
            assert c.level < node.level and np.linalg.norm(x[c.point] - node.centre) <= 2.0**node.level  # covering
            check(c)
        assert not node.children or node.point in [c.point for c in node.children]  # nesting

    check(tree)
    assert sorted(below(tree)) == list(range(len(x)))
    for level in levels:  # separation, of those too that stand at a level by nesting
        points = sorted({p for at, ps in levels.items() if at >= level for p in ps})
        d = np.sqrt(((x[points][:, None] - x[points][None]) ** 2).sum(2)) + np.eye(len(points)) * 1e9
        assert d.min() > 2.0**level
    assert len({p for ps in levels.values() for p in ps}) == min(90, len(np.unique(x, axis=0)))


def test_tree_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.integers(-90, 90, (700, 5)).astype(float)
    assert (x[:300] @ x[300:].T).max() <= K.reach(K.cover_tree(x[:300], 20), K.cover_tree(x[300:], 20))


def test_search_rules_out_most_of_clustered_rows():
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(40, 16)) * 200
    x = np.floor(centre[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 4)
    q, met = x[::20], []
    got = K.search(q, np.arange(0, 4000, 20), K.cover_tree(q, 50), x, np.arange(4000), K.cover_tree(x, 80), 20, np.full(len(q), -np.inf), met)
    assert sum(met) < 0.5 * len(q) * len(x)
    scores = q @ x.T
    scores[np.arange(len(q)), np.arange(0, 4000, 20)] = -np.inf
    best = -np.sort(-scores, axis=1)[:, :20]
    assert all((np.sort(got[2][got[0] == i])[::-1] == best[i]).all() for i in range(len(q)))


# ---- n-gram join --------------------------------------------------------------------------------------------------


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_join(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    up = list(range(len(sets)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                up[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        low[root(a)] = min(i, low.get(root(a), i))
    return sorted((i, len(s), low[root(a)]) for a, (i, s) in enumerate(sets))


def family(rng, words, n, edits):
    """Copies of a text with so many single words changed."""
    out = []
    for _ in range(n):
        w = list(words)
        for p in rng.sample(range(len(w)), min(len(w), rng.choice(edits))):
            w[p] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("peels", [J.PEELS, 0])
def test_join_against_all_pairs(spark, documents, clashing, monkeypatch, peels):
    monkeypatch.setattr(J, "PEELS", peels)
    monkeypatch.setattr(J, "HOT_SHARE", 4000)
    rng = random.Random(6)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(40))
    texts = []
    for size in (1, 3, 4, 5, 6, 9, 13, 20, 33, 60, 150, 400):
        base = [word() for _ in range(size)]
        texts += family(rng, base, 14, [0, 1, 1, 2, 3] if size < 100 else [0, 1, 2, 4, 6, 8])
        texts += [" ".join(base[: max(1, int(size * f))]) for f in (0.7, 0.8, 0.85, 0.95)]
    passage = " ".join(word() for _ in range(15))
    texts += [passage + " " + " ".join(word() for _ in range(rng.choice([3, 8, 12, 40]))) for _ in range(60)]
    texts += [t.upper() for t in texts[:40]] + [t.replace(" ", "\n\t") for t in texts[40:60]] + ["", "  ", None, "É a b c d", "é a b c d"]
    rng.shuffle(texts)
    docs = list(enumerate(texts, 100))
    got = sorted(tuple(r)[:3] for r in J.join(clashing(documents(docs))).collect())
    assert got == brute_join(docs)


def test_large_family(spark, documents):
    """Hundreds of near copies, of which many are not linked with the original."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    docs = list(enumerate([" ".join(base), *family(rng, base, 260, [1, 2, 3, 4, 5])]))
    assert sorted(tuple(r)[:3] for r in J.join(documents(docs)).collect()) == brute_join(docs)


def test_join_edges(spark, documents):
    d = documents([(1, None), (2, ""), (None, "a b c d e f"), (9, "a b c d e f"), (4, "A B C D E F"), (4, "other words in the same id"), (7, "x")])
    got = sorted(map(tuple, J.join(d).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (None, 2, 4), (9, 2, 4), (4, 2, 4), (4, 2, 4), (7, 1, 7)], key=str)
    assert J.join(d.limit(0)).count() == 0
    one = J.one_of_each(d)
    assert one.columns == d.columns and sorted((r.doc_id or 0, r.text) for r in one.where("text <> ''").collect()) == [(4, "A B C D E F"), (4, "other words in the same id"), (7, "x")]
    assert one.where("coalesce(text, '') = ''").count() == 2
    # an id on a copy and on a text of its own; repeated rows; groups without an id
    d = documents([(1, "a b c d e f"), (5, "a b c d e f"), (5, "only here"), (5, "only here"), (5, "only here"), (None, "g h i"), (None, "g h i"), (None, "g h i j k"), (8, None), (8, None)])
    assert sorted(((r.doc_id or 0, r.text or "") for r in J.one_of_each(d).collect())) == [(0, "g h i"), (0, "g h i j k"), (1, "a b c d e f"), (5, "only here"), (8, ""), (8, "")]


def test_names_that_clash(spark, documents, monkeypatch):
    """Texts whose digests share their 64 bits are still two sets."""
    name = J.node_of
    monkeypatch.setattr(J, "node_of", lambda text, clashes=None: F.when(F.lit(not clashes) & text.startswith("clash"), F.lit(7)).otherwise(name(text, clashes)))
    d = documents([(1, "clash of a b c d e"), (2, "clash of v w x y z"), (3, "other"), (4, "clash of a b c d e")])
    assert sorted(tuple(r)[:3] for r in J.join(d).collect()) == [(1, 3, 1), (2, 3, 2), (3, 1, 3), (4, 3, 1)]


def test_hub_far_from_its_family(spark, documents, monkeypatch):
    """Buckets whose first hub is linked with none of them get others; rows that a step makes grow with the sets, not with their pairs."""
    rng = random.Random(9)
    made, keep = {}, J.kept

    def kept(df, s, tag):
        made[n, tag] = out = keep(df, s, tag)
        return out

    monkeypatch.setattr(J, "kept", kept)
    for n in (30, 150):
        base = [f"w{i}" for i in range(200)]
        docs = list(enumerate([" ".join(base[:150] + [f"q{i}" for i in range(60)]), *family(rng, base, n, [1, 2, 3, 4, 5, 6, 7])]))
        assert sorted(tuple(r)[:3] for r in J.join(documents(docs)).collect()) == brute_join(docs)
    assert made[150, "join-tokens"].count() <= 12 * made[30, "join-tokens"].count()


def test_keys_of_one_place(spark, documents, monkeypatch):
    """Frequent keys come back from the places to which their salts deal them."""
    tables, keep, docs = {}, J.kept, list(enumerate(f"a b c d e f g h i j k l m{i % 9} n o p q r s t u v w x{i}" for i in range(40)))
    monkeypatch.setattr(J, "kept", lambda df, s, tag: tables.setdefault(tag, keep(df, s, tag)) if tag == "join-keys" else keep(df, s, tag))
    keys = []
    for share in (J.HOT_SHARE, 4000):  # no key is frequent; those in 4 texts or more are
        tables.clear()
        monkeypatch.setattr(J, "HOT_SHARE", share)
        assert sorted(tuple(r)[:3] for r in J.join(documents(docs)).collect()) == brute_join(docs)
        keys.append({tuple(r) for r in tables["join-keys"].collect()})
    assert keys[0] <= keys[1], keys[0] - keys[1]


def test_pairs_at_the_limit_share_enough(spark):
    """Random pairs of 18 to 36 shingles at the limit of similarity, where many segments are frequent: no set is pruned."""
    rng = np.random.default_rng(3)
    rows, sizes, node, pairs = [], [], 0, []
    for trial in range(3000):
        common = int(rng.integers(16, 33))
        either = 100 * common // 80
        more = int(rng.integers(0, either - common + 1))
        u = rng.integers(0, 1 << 63, either, dtype=np.uint64) * np.uint64(2)
        if trial % 2:  # one difference in each of the segments in use but one, others empty in both
            common, more, either, m = 24, 4, 30, J.segments(J.band_of(28))
            used = rng.permutation(m)[:7]
            at = np.r_[used, rng.choice(used, 17, p=rng.dirichlet(np.ones(7))), rng.permutation(used[1:])]
            u = (((at << 32) + rng.integers(0, 1 << 32, 30)) // m).astype(np.uint64) << np.uint64(32) | rng.integers(0, 1 << 32, 30, dtype=np.uint64)
        x, y = np.sort(u[: common + more]), np.sort(np.r_[u[:common], u[common + more :]])
        if len(np.unique(u)) < either or not 18 <= min(len(x), len(y)) <= max(len(x), len(y)) <= 36:
            continue
        if trial % 3 == 0:  # so few segments in use that only empty ones may be alike
            m = J.segments(J.band_of(len(x)))
            at = rng.choice(rng.permutation(m)[: rng.integers(2, 7)], either)
            u = (((at << 32) + rng.integers(0, 1 << 32, either)) // m).astype(np.uint64) << np.uint64(32) | rng.integers(0, 1 << 32, either, dtype=np.uint64)
            x, y = np.sort(u[: common + more]), np.sort(np.r_[u[:common], u[common + more :]])
        keys = np.unique(np.concatenate([J._named(J._keys(s, b)[0], np.arange(J.segments(b)), b, 0) for s in (x, y) for b in (J.band_of(len(s)), J.band_of(len(s)) - 1)]))
        hot = keys[rng.random(len(keys)) < rng.choice([0, 0.3, 0.6, 0.9])]
        freq = rng.choice([4.0, 50.0, 3000.0], len(hot))
        found = [set(zip(*map(np.ndarray.tolist, J.rows_of(s, hot, freq)), strict=True)) for s in (x, y)]
        meet = {k for k, _ in found[0]} & {k for k, _ in found[1]}
        of = {k: [r for f in found for q, r in f if q == k] for k in meet}
        meet = {k for k, rs in of.items() if any(r % J.SHORT not in (J.INDEXED, J.SIZE) for r in rs) and any(r % J.SHORT in (J.INDEXED, J.BOTH, J.ELEMENT) for r in rs)}
        for s, f in zip((x, y), found, strict=True):
            band = J.band_of(len(s))
            rows += [(k - (1 << 64) if k >> 63 else k, node, r) for k, r in f if k in meet]
            sizes.append((node, len(s), J.shares(band), J.shares(band - 1)))
            node += 1
        pairs.append((node - 2, node - 1))
    left = {}
    for r in J.enough(spark.createDataFrame(rows, J._ROWS), spark.createDataFrame(sizes, "node long, n long, q_own long, q_below long")).collect():
        left.setdefault(r.node, set()).add(r.key)
    assert len(pairs) > 1000 and all(left.get(a, set()) & left.get(b, set()) for a, b in pairs)


def test_sketches_bound_from_below():
    rng = np.random.default_rng(1)
    for n in (5, 90, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.r_[a[: n * 4 // 5], rng.integers(0, 1 << 63, n // 3, dtype=np.uint64) * np.uint64(2)])
        assert J.apart(J.sketch(a), J.sketch(b)) <= len(np.setxor1d(a, b))


# ---- quality ------------------------------------------------------------------------------------------------------


def test_quality_held_out(spark, documents):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(["house", "river", "and", "of", "walks", "green"]) for _ in range(rng.randint(20, 80))) + "."
    bad = lambda: " ".join(w.upper() + "!!" for w in good().split()) if rng.random() < 0.5 else " | ".join(good().split())
    rows = [(i, good() if i % 3 else bad()) for i in range(900)] + [(2000, None), (2001, ""), (2002, "x" * 200_000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(900)] + [(5, None, 0), (9999, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    d = documents(rows)
    model = Q.train(d, labels)
    out = {r.doc_id: r for r in Q.score(d, model).collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    held = [r for r in out.values() if r.held_out and r.doc_id < 900]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert sum(r.predicted == int(r.doc_id % 3 > 0) for r in held) >= 0.97 * len(held)
    kept = Q.accepted(d, labels)
    assert kept.columns == d.columns and kept.count() == sum(r.predicted for r in out.values())
    assert 0 < len(model.rules) < Q.TREES * (2 ** (Q.DEPTH + 1) - 2)


def test_quality_compiled_like_numpy(spark, documents):
    stats = Q.statistics(F.col("text"))
    names = list(stats)
    model = Q.Model(0.3, (Q.Rule((("upper", True, 0.2), ("bangs", False, 0.1)), -1.5), Q.Rule((("log_chars", False, 2.0),), 0.7)))
    d = documents([(1, "ABC d"), (2, ""), (3, "a b c d e f g!"), (4, None)])
    x = np.array([list(r) for r in d.orderBy("doc_id").select(*[c.alias(n) for n, c in stats.items()]).collect()], float)
    got = [r.score for r in Q.score(d, model).orderBy("doc_id").collect()]
    assert np.allclose(got, model.predict(x, names))


def test_quality_without_labels(spark, documents):
    d = documents([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.score(d, Q.train(d, none)).collect()] == [0.5, 0.5]
    assert Q.score(d.limit(0), Q.train(d, none)).count() == 0


def test_splits_are_the_best_ones():
    """A tree's first split is the one that trying all cuts of all statistics finds."""
    rng = np.random.default_rng(5)
    for _ in range(10):
        x, y = rng.integers(0, 9, (60, 3)).astype(float), rng.normal(size=60)
        y += (x[:, 1] > 4) * rng.choice([0, 2])
        names, cuts, found = ["a", "b", "c"], [np.unique(x[:, j]) for j in range(3)], []
        Q._grow(x, y, names, cuts, 1, (), 5, found, np.zeros(60), np.arange(60))
        loss = {(names[j], c): sum(((s - s.mean()) ** 2).sum() for s in (y[x[:, j] <= c], y[x[:, j] > c])) for j in range(3) for c in cuts[j] if 5 <= (x[:, j] <= c).sum() <= 55}
        name, _, cut = found[0][-1]
        assert abs(loss[name, cut] - min(loss.values())) < 1e-9


def test_lasso_is_optimal():
    """Where a weight is 0 the slope is within the penalty; elsewhere it is the penalty."""
    rng = np.random.default_rng(6)
    r = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(1 - 2 * r[:, 2] + 1.5 * r[:, 5]))).astype(float)
    b, w = Q.lasso_logistic(r, y, 0.02, 4000)
    e = 1 / (1 + np.exp(-(r @ w + b))) - y
    slope = r.T @ e / len(y)
    assert abs(e.mean()) < 1e-4 and np.all(np.abs(slope) <= 0.02 + 1e-4) and np.allclose(slope[w != 0], -0.02 * np.sign(w[w != 0]), atol=1e-4)


def test_lasso_is_sparse():
    rng = np.random.default_rng(0)
    r = (rng.random((500, 30)) < 0.5).astype(float)
    y = (r[:, 3] + r[:, 7] > 1).astype(float)
    _, w = Q.lasso_logistic(r, y, 0.05)
    assert set(np.flatnonzero(w)) <= {3, 7} and len(np.flatnonzero(w)) == 2


# ---- urls ---------------------------------------------------------------------------------------------------------


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3 :]
    m = re.match(r"([^/?#]*)([^?#]*)", rest, re.S)
    host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
    best = None
    for _, r in U.RULES:
        h, p = r.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best)):
            best = r
    return host, path, best


def test_rules_and_parts(spark, clashing):
    rng = random.Random(2)
    hosts = ["example.org", "a.example.org", "xexample.org", "ORG", "a.com", "com", "É.com", "", "x.net:80"]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/es/1', '/en/1', '/en/12', '/fr/', '/de/x', '/de', '?q=/de/', '#a', '/en/a?b#c'])}" for _ in range(300)] + [None, "", "no scheme", "a://b://c/de/", "//x"]
    rows = list(enumerate(urls)) + [(0, urls[0])]
    got = U.judge(clashing(spark.createDataFrame(rows, "page_id long, url string"))).collect()
    assert len(got) == len(rows)
    verdict = {r: v for v, r in U.RULES}
    for r in got:
        host, path, rule = brute_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[r.page_id]
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == verdict[rule])


def test_templates(spark):
    """A branch whose labelled urls are all blocked stays apart from its siblings, and blocks the rest of itself."""
    rules = (("block", "h.io/bad/1"), ("allow", "h.io/good/1"))
    urls = [f"http://h.io/{b}/{n}{i}/p" for b in ("bad", "good") for n in "12" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.path.split("/")[1], r.rule is None): (r.verdict, r.template) for r in U.judge(df, rules=rules).collect()}
    assert got["bad", True] == ("block", "/bad/*/*") and got["good", True] == ("allow", "/good/*/*")
    assert U.judge(df.limit(0)).count() == 0
    assert U.judge(df, rules=()).where("verdict = 'block'").count() == 0


def test_unlabelled_branches_stay_apart(spark):
    """A host that has only /de/ labels says nothing of its /en/ and /es/ urls; nor do few labels merge with them."""
    for n in (7, 60):
        urls = [f"http://h.com/{b}/{w}/p" for b, k in (("de", n), ("en", 90), ("es", 30)) for w in ("abc"[i % 3] * 3 for i in range(k))]
        urls += [f"http://g.com/fr/{i}" for i in range(n)]
        got = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).where("host = 'h.com'").collect()
        for r in got:
            branch = r.path.split("/")[1]
            assert r.template.startswith(f"/{branch}/") and r.verdict == ("block" if branch == "de" else "allow"), r


def brute_tree(urls):
    """(host, segments) -> (template, purity) of urls (host, segments, label), with plain loops."""
    base = {}
    for h, segs, y in urls:
        c = base.setdefault((h, segs), [0, 0, 0])
        c[0] += 1
        c[1] += y is not None
        c[2] += y or 0
    t = {key: key[1] for key in base}
    add = lambda a, b: [x + y for x, y in zip(a, b, strict=True)]
    for d in range(max(len(s) for _, s in base), 0, -1):
        at = {}
        for key, c in base.items():
            if len(t[key]) >= d:
                k = (key[0], t[key][: d - 1], t[key][d - 1])
                at[k] = add(at.get(k, [0, 0, 0]), c)
        stays = set()
        for (h, p, o), (n, k, bad) in at.items():
            kin = [c for (h2, p2, _), c in at.items() if (h2, p2) == (h, p)]
            an, ak, ab = (sum(c[i] for c in kin) for i in range(3))
            if k and ak > k:
                err = math.sqrt(ab / ak * (1 - ab / ak) * (1 / k + 1 / (ak - k)))
                own = abs(bad / k - (ab - bad) / (ak - k)) > U.Z * err
            else:
                own = an > n and (len(kin) < U.VARIABLE or U.VARIABLE * n >= an)
            if own and n >= U.SUPPORT and o != "*":
                stays.add((h, p, o))
        for key in base:
            if len(t[key]) >= d and (key[0], t[key][: d - 1], t[key][d - 1]) not in stays:
                t[key] = (*t[key][: d - 1], "*", *t[key][d:])
    count, kinds = {}, {}
    for (h, s), c in base.items():
        for i in range(len(t[h, s]) + 1):
            for node in {(h.rsplit(".", 1)[-1], h, *t[h, s][:i])} | ({(h.rsplit(".", 1)[-1],)} if i == 0 else set()):
                count[node] = add(count.get(node, [0, 0, 0]), c)
                kinds.setdefault(node, set()).update([s[:i]] * bool(c[1]))

    def prior(node):
        if not node:
            return 0.5
        kin = [(c, max(1, len(kinds[other])) if len(node) > 2 else 1) for other, c in count.items() if len(other) == len(node) and other[:-1] == node[:-1] and other != node and c[1]]
        return (sum(m * c[2] / c[1] for c, m in kin) + U.BRANCHES * prior(node[:-1])) / (sum(m for _, m in kin) + U.BRANCHES)

    out = {}
    for h, s in base:
        node = (h.rsplit(".", 1)[-1], h, *t[h, s])
        _, k, bad = count[node]
        out[h, s] = (t[h, s], (bad + U.PRIOR * prior(node)) / (k + U.PRIOR))
    return out


def test_tree_against_loops(spark):
    rng = random.Random(4)
    urls = []
    for _ in range(1500):
        h = rng.choice(["a.com", "b.com", "c.net", "d.net"])
        segs = tuple(rng.choice(["x", "y", "*", *(f"s{i}" for i in range(30))] if rng.random() < 0.4 else ["x", "y"]) for _ in range(rng.randint(0, 4)))
        urls.append((h, segs, rng.choice([None, None, int(segs[:1] == ("x",)) if rng.random() < 0.9 else 0])))
    got = U.tree(spark.createDataFrame(urls, "host string, segs array<string>, label int"), spark).collect()
    want = brute_tree(urls)
    assert len(got) == len(want)
    for r in got:
        template, purity = want[r.host, tuple(r.segs)]
        assert tuple(r.template) == template and abs(r.purity - purity) < 1e-9, r


def test_urls_without_a_rule_are_blocked_on_evidence(spark):
    """Beside many branches that are all blocked, an unlabelled one is rejected; so is a branch's own root; deep segments count."""
    rules = tuple(("block", f"h.io/b{i}/") for i in range(12)) + tuple(("allow", f"g.io/b{i}/") for i in range(12)) + (("block", "d.io/1/2/3/4/5/6/7/bad/1"), ("allow", "d.io/1/2/3/4/5/6/7/good/1"))
    urls = [f"http://{h}.io/b{i}/{j}" for h in "hg" for i in range(12) for j in range(8)] + [f"http://{h}.io/new/{j}" for h in "hg" for j in range(8)] + ["http://h.io/b1", "http://g.io/b1"]
    urls += [f"http://d.io/1/2/3/4/5/6/7/{b}/{n}{i}/" for b in ("bad", "good") for n in "12" for i in range(30)]
    got = U.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules=rules).where("rule IS NULL").collect()
    assert {(r.host, r.path.split("/")[1], r.path.split("/")[8] if r.host == "d.io" else "", r.verdict) for r in got} == {("h.io", "new", "", "block"), ("g.io", "new", "", "allow"), ("h.io", "b1", "", "block"), ("g.io", "b1", "", "allow"), ("d.io", "1", "bad", "block"), ("d.io", "1", "good", "allow")}


# ---- tokens -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(planes):
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 100, 1000):
        for high in (2, 50257, 1 << 32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype("<u4")
            blob = T.pack_chunk([1, None], [ids[: n // 3], ids[n // 3 :]], planes, block=64)
            assert np.array_equal(np.concatenate([*T.chunk_blocks(blob), np.empty(0, "<u4")]), ids)
            names, lens = T.chunk_documents(blob)
            assert list(names) == [1, T.NULL_ID] and list(lens) == [n // 3, n - n // 3]
    block = list(T.chunk_blocks(T.pack_chunk([1], [np.arange(200, dtype="<u4")], planes, block=64), 2, 3))
    assert len(block) == 1 and list(block[0]) == list(range(128, 192))


def test_encoder_is_the_library():
    enc = T.Encoder(T.tokenizer_path())
    rng, letters = random.Random(0), "ab '\"_-s tdl\n\t\r  12²½éßñ,.<|>!中文あ가Ωя​\xa0\x1c \x00"
    for _ in range(3000):
        s = "".join(rng.choices(letters, k=rng.randint(0, 24)))
        assert np.frombuffer(enc(s), "<u4").tolist() == enc.library.encode(s, add_special_tokens=False).ids, repr(s)
    for s in ("a <|endoftext|> b", " the quick  brown\n\nfox's 123"):
        assert np.frombuffer(enc(s), "<u4").tolist() == enc.library.encode(s, add_special_tokens=False).ids


def test_store(spark, documents, clashing, tmp_path):
    rng = random.Random(1)
    rows = [(i * 3 % 101, " ".join(rng.choice(["the", "river", "Äpfel", "x1"]) for _ in range(rng.choice([0, 1, 40, 3000])))) for i in range(101)]
    rows += [(500, None), (501, ""), (7, "again"), (7, "again"), (None, "no id")]
    path = f"file://{tmp_path}/store"
    T.write_store(clashing(documents(rows)), path, chunk_ids=5000, block=512, shards=3)
    got = T.digest_store(spark, path).orderBy("start").collect()
    enc = T.Encoder(T.tokenizer_path()).library
    at, left = 0, [(d, [*enc.encode(t or "", add_special_tokens=False).ids, 2]) for d, t in rows]
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(d for d, _ in rows if d is not None)
    for r in got:
        own = next(x for x in left if x[0] == r.doc_id and (len(x[1]), zlib.crc32(np.array(x[1], "<u4").tobytes())) == (r.n_tokens, r.ids_crc32))
        left.remove(own)
        assert r.start == at
        at += r.n_tokens
    assert not left
    some = {r.doc_id: r.ids for r in T.read_store(spark, path, 500, 501).collect()}
    assert some == {500: [2], 501: [2]}
    T.write_store(documents(rows).limit(0), path)
    assert T.digest_store(spark, path).count() == 0


# ---- pipeline -----------------------------------------------------------------------------------------------------


def test_pipeline(spark, documents, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(5)
    clean = lambda: " ".join(rng.choice(["house", "river", "and", "walks", "green", "stone", "under"]) + str(rng.randrange(50)) for _ in range(60)) + "."
    bench = " ".join(f"exam{i}" for i in range(30))
    rows = [(i, clean(), f"s{i % 3}") for i in range(300)]
    rows += [(300 + i, rows[i][1], "s0") for i in range(40)] + [(400 + i, bench + " " + clean()[:80], "s1") for i in range(10)]
    rows += [(500 + i, " ".join(w.upper() + "!!" for w in clean().split()), "s2") for i in range(90)]
    d = documents(rows)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 500), 0) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = d, []
    for k, (_, stage) in enumerate(C.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if k < len(C.STAGES) - 1:
            assert docs.columns == d.columns
        docs.write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert seen[0] == {i for i, *_ in rows if i < 500}
    assert seen[1] == seen[0] - set(range(300, 340))
    assert seen[2] == seen[1] - set(range(400, 410))
    assert seen[3] <= seen[2] and seen[4] == seen[3] and {"shard", "slot"} <= set(docs.columns)
    whole = C.run(spark, str(tmp_path))
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


def test_a_turn_joins_its_rows_once(spark, monkeypatch):
    """The rows of open buckets are kept before hubs are chosen, which reads them several times."""
    plans, keep = [], J.kept

    def kept(df, s, tag):
        plans.append((tag, df._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi")))
        return keep(df, s, tag)

    monkeypatch.setattr(J, "kept", kept)
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60)) + f" x{i % 3}") for i in range(6)], "doc_id long, text string")
    assert {r.component_id for r in J.join(docs, spark).collect()} == {0}
    assert "join-rest" in dict(plans) and max(n for _, n in plans) <= 1, plans


def test_open_rows_are_looked_for_only_before_another_hub(spark, monkeypatch):
    """The last turn does not join the rows of open buckets again: no turn follows that would use them."""
    tags, keep = [], J.kept
    monkeypatch.setattr(J, "kept", lambda df, s, tag: (tags.append(tag), keep(df, s, tag))[1])
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60)) + f" x{i % 3}") for i in range(6)], "doc_id long, text string")
    for peels in (0, 1):
        monkeypatch.setattr(J, "PEELS", peels)
        tags.clear()
        assert {r.component_id for r in J.join(docs, spark).collect()} == {0}
        assert tags.count("join-rest") == tags.count("join-left") == peels
