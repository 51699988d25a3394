"""Sharding, mixing, decontamination, personal data: against brute force and the defined results."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from folioscope.llm import decontaminate as DC
from folioscope.llm import mixing as M
from folioscope.llm import pii as P
from folioscope.llm import sharding as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# ---- sharding -----------------------------------------------------------------------------------------------------


def test_table_is_fair_and_stable():
    t = S.lookup_table(S.shard_names(32))
    n = Counter(t)
    assert len(t) == 4099 and max(n.values()) - min(n.values()) <= 1
    less = S.lookup_table(S.shard_names(31))
    moved = sum(a != b for a, b in zip(t, less, strict=True) if a < 31)
    assert moved < 0.3 * len(t)
    heavy = Counter(S.lookup_table(("a", "b"), 101, (3, 1)))
    assert heavy[0] in (75, 76)
    for bad in (((), 11, None), (("a", "a"), 11, None), (("a",), 12, None), (("a",), 11, (0,))):
        with pytest.raises(ValueError):
            S.lookup_table(*bad)


def test_table_by_brute_force():
    names, size = S.shard_names(5), 53
    order = {s: [(S._number(f"offset:{s}") + j * (S._number(f"skip:{s}") % (size - 1) + 1)) % size for j in range(size)] for s in names}
    own = {}
    while len(own) < size:
        for i, s in enumerate(names):
            slot = next((x for x in order[s] if x not in own), None)
            if slot is not None:
                own[slot] = i
    assert S.lookup_table(names, size) == tuple(own[k] for k in range(size))


def test_placement(spark, documents, clashing, tmp_path):
    d = clashing(documents([(1, "a"), (1, "a"), (None, None), (7, "")]))
    out = S.place(d, slot_col="slot")
    got = out.select("slot", "shard").collect() if out.columns.count("shard") == 1 else out.collect()
    assert len(got) == 4 and all(0 <= r.shard < 32 for r in got)
    plain = documents([(1, "a"), (1, "a"), (None, None)])
    a = {(r.doc_id, r.shard) for r in S.place(plain).collect()}
    assert len(a) == 2 and S.place(plain).columns == [*plain.columns, "shard"]
    assert S.place(plain.limit(0)).count() == 0
    S.write_shards(plain, str(tmp_path / "s"), slices=2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    S.write_shards(d.withColumn("Shard_2", F.lit(3)), str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 4 and {"doc_id", "DOC_ID_2", "Text_2", "shard_2", "Shard_2_2", "shard"} <= set(back.columns)
    assert sorted(map(str, back.select("doc_id", "shard").collect())) == sorted(str(r) for r in S.place(documents([(1, "a"), (1, "a"), (None, None), (7, "")])).select("doc_id", "shard").collect())


# ---- mixing -------------------------------------------------------------------------------------------------------


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest, free = total - sum(2 * sizes[s] for s in full), [s for s in names if s not in full]
        t = {s: 2.0 * sizes[s] for s in full} | {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > 2 * sizes[s]]
        if not over:
            return t
        full |= set(over)


def test_targets_and_takes(spark, documents, clashing):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 40])), rng.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(900)]
    rows += [(2000, None, "b"), (2001, "  \n", "only blank"), (2002, "x y z", "nb"), (3, "again the same id", "a"), (3, "again the same id", "a")]
    d = documents(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets(sizes)
    out = M.mix(clashing(d)).collect()
    assert len(out) == len(rows) and {r.source: r.source_size for r in out} == dict(sizes)
    took, largest = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size and len(r.shards) == r.copies
        took[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(took[s] - want[s]) <= max(largest[s], 1), s
    again = M.mix(d.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken, tuple(r.shards)) for r in out) == sorted((r.doc_id, r.taken, tuple(r.shards)) for r in again)
    mixed = M.mixed_documents(d)
    assert mixed.columns == d.columns and mixed.count() == sum(r.copies for r in out)
    assert M.mix(d.limit(0)).count() == 0


def test_written_mix(spark, documents, tmp_path):
    d = documents([(i, f"one two {i}", "ab"[i % 2]) for i in range(200)])
    M.write_mix(d, str(tmp_path / "mix"), shards=4, files=2)
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.count() == M.mixed_documents(d, shards=4).count() and {r[0] for r in back.select("out_shard").distinct().collect()} == {0, 1, 2, 3}


def test_splitting_tree():
    quotas = [100, 37, 5, 0, 1]
    parts = M.split_quotas(quotas, 8, 3)
    assert [sum(c) for c in zip(*parts, strict=True)] == quotas and max(map(sum, parts)) - min(map(sum, parts)) <= 1
    rng = random.Random(1)
    mean = sum(M.hypergeometric(rng, 30, 70, 20) for _ in range(4000)) / 4000
    assert abs(mean - 6) < 0.15
    assert all(max(0, n - b) <= M.hypergeometric(rng, g, b, n) <= min(g, n) for g in range(6) for b in range(6) for n in range(g + b + 1))


# ---- decontamination ----------------------------------------------------------------------------------------------


def contamination(docs, bench):
    windows = defaultdict(set)
    for i, t in bench:
        w = WORD.findall(low(t))
        n = min(13, len(w))
        for s in range(len(w) - n + 1) if w else ():
            windows[n, tuple(w[s : s + n])].add(i)
    lens = sorted({n for n, _ in windows})
    out = []
    for i, t in docs:
        w, hit, items = WORD.findall(low(t)), set(), set()
        for n in lens:
            for s in range(len(w) - n + 1):
                if got := windows.get((n, tuple(w[s : s + n]))):
                    hit |= set(range(s, s + n))
                    items |= got
        ids = ",".join(sorted(map(str, items)))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [DC.MAX_SET, 0])
def test_contamination(spark, documents, clashing, monkeypatch, most):
    monkeypatch.setattr(DC, "MAX_SET", most)
    rng = random.Random(9)
    vocab = ["a", "b", "É", "é", "Σας", "ΣΑΣ", "x1", "the", "İ", "ß"]
    text = lambda n: rng.choice(["", " ", ".!"]) + " ".join(rng.choice(vocab) for _ in range(n))
    bench = [(i, text(rng.choice([1, 2, 3, 5, 12, 13, 14, 30, 45]))) for i in range(25)] + [(90, None), (91, "..."), (0, "another text of item zero that is long enough to make a window by itself yes")]
    docs = [(i, text(rng.choice([0, 1, 5, 20, 60]))) for i in range(60)] + [(100, None), (101, "")]
    for i in range(40):
        b = rng.choice([t for _, t in bench if t])
        docs.append((200 + i, text(rng.randint(0, 30)) + " , " + b.upper() + "; " + text(rng.randint(0, 80))))
    docs += [docs[70], docs[70]]
    d = clashing(documents(docs))
    b = spark.createDataFrame(bench, "item_id long, text string")
    assert sorted(map(tuple, DC.report(d, b).collect()), key=str) == contamination(docs, bench)


def test_clean_and_empty(spark, documents):
    passage = " ".join(f"word{i}" for i in range(20))
    d = documents([(1, "clean text"), (2, f"Intro {passage} end"), (3, None), (2, "other text of the same id")])
    b = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert sorted((r.doc_id, r.text) for r in DC.clean(d, b).where("text IS NOT NULL").collect()) == [(1, "clean text"), (2, "other text of the same id")]
    assert DC.clean(d, b).count() == 3
    assert {r.text for r in DC.clean(d, b, spans=True).where("doc_id = 2").collect()} == {"intro end", "other text of the same id"}
    assert DC.report(d, b.limit(0)).where("contaminated").count() == 0 and DC.report(d.limit(0), b).count() == 0


def test_common_openings_make_few_rows(spark, documents, monkeypatch):
    """Items and documents that begin alike, but have no window in common, are never paired."""
    made, keep = {}, DC.kept

    def kept(df, s, tag):
        made[tag] = out = keep(df, s, tag)
        return out

    monkeypatch.setattr(DC, "kept", kept)
    opening = "which of the following statements is true about"
    b = spark.createDataFrame([(i, f"{opening} " + " ".join(f"i{i}x{j}" for j in range(20))) for i in range(200)], "item_id long, text string")
    d = documents([(i, f"{opening} " + " ".join(f"d{i}x{j}" for j in range(30))) for i in range(200)] + [(900, f"x {opening} " + " ".join(f"i7x{j}" for j in range(20)))])
    got = {r.doc_id: (r.n_hit, r.n_items) for r in DC.report(d, b).collect()}
    assert got.pop(900) == (28, 1) and set(got.values()) == {(0, 0)} and made["bench-met"].count() == 16


# ---- personal data ------------------------------------------------------------------------------------------------

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    return sum(v - 9 if (v := int(c) * (1 + i % 2)) > 9 else v for i, c in enumerate(reversed(s))) % 10 == 0


def base(t):
    out = []
    for k, (kind, p) in enumerate(KINDS.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_base_spans(spark, documents, clashing):
    rng = random.Random(3)
    bits = ["a", "b@", "@", "c.d", ".", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.4", "4111 1111 1111 1111", "4111111111111112", "+1 (988) 555-2485", "+", "12", "-", " ", "x@y.z", "x@y.z_q@r.s", "é", "\n", "12345678901234567890123", "+49 30 123456 - ", "%", "😀"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 12)))) for i in range(600)] + [(900, None), (901, ""), (902, "a" * 50_000 + "@"), (903, "7" * 50_000)]
    for r, (i, t) in zip(sorted(P.report(clashing(documents(rows))).collect(), key=lambda r: r.doc_id), rows, strict=True):
        want = base(t)
        assert r.doc_id == i and r.base_sha256 == hashlib.sha256(",".join(s for _, _, s in want).encode()).hexdigest(), t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert {s for _, _, s in want} <= set(r.spans.split(","))


def test_contexts_find_more(spark, documents):
    """After "call:" stand phone numbers, some without the form of one; "the" stands before anything."""
    rows = [(i, f"the 55512{i} and the word call: +1 555 010 {1000 + i} now the end") for i in range(12)] + [(50, "please call: 555-0199-88 soon"), (51, "the 987654 items"), (52, "nothing")]
    got = {r.doc_id: r for r in P.report(documents(rows)).collect()}
    at = rows[12][1].index("555-0199-88")
    assert got[50].spans == f"phone:{at}:{at + 11}" and got[50].n_phone == 0 and got[50].n_more == 1
    assert got[51].spans == "" and got[52].spans == ""
    assert P.report(documents(rows).limit(0)).count() == 0


def test_contexts_find_other_forms(spark, documents):
    """Addresses without a dotted domain, and numbers in short groups; a single group of few digits is none."""
    rows = [(i, f"write mailto: u{i}@h{i}.org or call: +1 555 010 {1000 + i} now") for i in range(12)]
    more = [("mailto: user@localhost please", "email", "user@localhost"), ("so call: (555) 123 456 soon", "phone", "(555) 123 456"), ("mailto: name@intranet", "email", "name@intranet"), ("call: 1234 56 78", "phone", "1234 56 78")]
    rows += [(50 + i, t) for i, (t, *_) in enumerate(more)] + [(60, "the 12 items @ 34 pay @ home")]
    got = {r.doc_id: r for r in P.report(documents(rows)).collect()}
    for i, (t, kind, value) in enumerate(more):
        assert got[50 + i].spans == f"{kind}:{t.index(value)}:{t.index(value) + len(value)}" and got[50 + i].n_more == 1, t
    assert got[60].spans == ""


def test_found_values_induce_patterns(spark, documents):
    """"ring:" stands beside no base span; values that "call:" tells make it a pattern in a later round, which finds one more."""
    rows = [(i, f"so please call: +1 555 010 {1000 + i} now, {i}th") for i in range(12)]
    rows += [(20 + i, f"so please call: 555-0{i}99-88 now") for i in range(4)] + [(30 + i, f"or better ring: 555-0{i}99-88, today") for i in range(4)]
    rows += [(40, "or better ring: (777-12-34); tomorrow"), (41, "a list of 99887766 things")]
    d = documents(rows)
    late = {r.doc_id: [(m.start, m.end, m.value) for m in r.more] for r in P.find(d).collect()}
    early = {r.doc_id: r.more for r in P.find(d, rounds=1).collect()}
    at = rows[-2][1].index("777") - 1
    assert late[40] == [(at, at + 11, "(777-12-34)")] and late[41] == [] and early[40] == [] and all(len(late[k]) == 1 for k in (20, 23, 30, 33))


def test_patterns_of_two_words(spark, documents):
    """"number" stands before anything, "phone number" before phone numbers."""
    rows = [(i, f"phone number +1 555 010 {1000 + i} and number {100000 + i} of many, number {200000 + i} too, number {300000 + i} again") for i in range(12)]
    got = {r.doc_id: r.spans for r in P.report(documents([*rows, (50, "phone number 555-77-88-99 is it")])).collect()}
    assert got[50] == "phone:13:25" and all(got[i].count(",") == 0 for i in range(12))


def test_long_texts_of_any_form(spark, documents):
    """Linear time and no deep recursion, also where an expression would like to go back."""
    texts = ["a@" + "b." * 50_000 + "c", "x" * 1_000_000, "1 2 " * 30_000, "12 " * 30_000 + "1.2.3.4", "4111111111111111, " * 4_000, "@" * 50_000, "+1" + " " * 100_000, "1." * 30_000, "\"(" * 50_000 + "1234"]
    got = {r.doc_id: r for r in P.report(documents(list(enumerate(texts)))).collect()}
    for i in (0, 4):
        assert got[i].base_sha256 == hashlib.sha256(",".join(s for _, _, s in base(texts[i])).encode()).hexdigest()
    assert got[0].n_email == 1 and got[4].n_card == 4_000 and got[3].n_ip == 1


def test_dense_text(spark, documents):
    """50,000 addresses and as many ids in one text, beside a text with few."""
    text = " ".join(f"u{i}@h{i % 50}.org id{100_000 + i}" for i in range(50_000))
    began = time.monotonic()
    got = {r.doc_id: r for r in P.report(documents([(1, text), (2, "u1@h1.org")])).collect()}
    assert time.monotonic() - began < 60
    assert got[1].base_sha256 == hashlib.sha256(",".join(s for _, _, s in base(text)).encode()).hexdigest() and got[1].n_email == 50_000 and got[2].n_email == 1


def test_masked(spark, documents):
    d = P.find(documents([(1, "é mail a@b.cd or 1.2.3.4!")])).select(P.masked(F.lit("é mail a@b.cd or 1.2.3.4!"), F.col("base")).alias("m"))
    assert d.first()["m"] == "é mail <EMAIL> or <IP>!"


def test_dense_hits(spark, documents):
    """A long text that consists of hit words: windows come once each, in time that grows with it."""
    words = [f"w{i % 97}x{i % 101}" for i in range(30_000)]
    item = " ".join(words[:9797])
    docs, bench = documents([(1, " ".join(words)), (2, "no " + " ".join(words[5:17]))]), spark.createDataFrame([(7, item)], "item_id long, text string")
    began = time.time()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in DC.report(docs, bench, spark).collect()}
    assert got == {1: (30_000, 30_000, 1), 2: (13, 0, 0)} and time.time() - began < 60
