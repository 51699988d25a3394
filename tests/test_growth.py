"""Growth rules: hand-computed points, and the native arithmetic against the text rules."""

import random

from pyspark.sql import functions as F

from folioscope.functions import numbers
from folioscope.operators import growth
from folioscope.operators.growth import GrowthRule, RuleSet, clause_at, is_table, scored, scored_rows, trimmed
from folioscope.plans import catalog


def total(text, *rules, industries=()):
    return RuleSet(tuple(rules)).score(text, industries)


def test_worked_numbers():
    rule = GrowthRule(phrase="增长", negate_if_contains=())
    assert [total(f"增长{v}%", rule)[0] for v in (20, 50, 100, 200)] == [2, 5, 10, 20]
    assert total("增长19.9%", rule) == (0, [])
    assert total("增长900%", rule)[0] == 30


def test_shipped_rules():
    banks = ((("银行I", "非银金融I", "金融服务I"), 0.15),)
    one = GrowthRule(phrase="同比增长", cap=12, company_markers=("本公司",), industry_multipliers=banks, negate_if_contains=())
    assert total("收入同比增长25.5%", one)[0] == 2
    assert total("收入同比增长300%", one)[0] == 12
    assert total("收入同比增长300%", one, industries=["银行I"])[0] == 2
    assert total("本公司收入同比增长300%", one, industries=["银行I"])[0] == 12  # the company itself: no multiplier
    two = GrowthRule(phrase="同比减少", polarity="neg", cap=6, negate_if_contains=())
    assert total("收入同比减少45%", two)[0] == -4
    four = GrowthRule(phrase="复合增长率", min_pct=15, cap=12, score_multiplier=0.5, negate_if_contains=())
    assert total("复合增长率15%", four)[0] == 1 and total("复合增长率200%", four)[0] == 6


def test_zero_means_default():
    r = GrowthRule.of({"phrase": "增长", "cap": 0, "k": 0, "window_chars": 0, "score_multiplier": -1})
    assert (r.cap, r.k, r.window_chars, r.score_multiplier) == (30, 0.1, 220, 1.0)


def test_adjustments():
    r = GrowthRule(phrase="增长", negate_if_contains=("成本",), neutralize_if_contains=("行业",), full_negate_if_contains=("亏损",))
    assert total("成本增长80%", r)[0] == -4
    assert total("行业成本增长80%", r) == (0, total("行业成本增长80%", r)[1]) and total("行业增长80%", r)[1][0].polarity == "pos"
    assert total("亏损成本增长80%", r)[0] == -8
    # an empty clause neither neutralises nor negates
    assert total("□适用成本增长80%", r)[0] == 8


def test_repeats_and_aliases():
    r = GrowthRule(phrase="复合增长率", phrase_aliases=("年复合增长率",), negate_if_contains=())
    pts, hits = total("年复合增长率30%。年复合增长率30%", r)
    assert (pts, sorted((h.keyword, h.count) for h in hits)) == (6, [("复合增长率=30%", 1), ("年复合增长率=30%", 1)])
    n = GrowthRule(phrase="增长", negate_if_contains=(), neutralize_if_contains=("行业",))
    pts, hits = total("行业增长50%。公司增长50%", n)
    assert pts == 5 and (hits[0].weight, hits[0].count) == (5, 2)  # the stored product is 10, the score 5


def test_window_and_stops():
    r = GrowthRule(phrase="增长", window_chars=5, negate_if_contains=())
    assert total("增长一二三四50%", r) == (0, []) and total("增长。50%", r) == (0, [])
    assert total("增长,一50%", r)[0] == 5
    assert total("", r) == (0, []) and total(None, r) == (0, [])


def test_thresholds_and_bad_patterns():
    r = GrowthRule.of({"phrase": "增长", "mode": "thresholds", "thresholds": [{"ge": 50, "score": 5}, {"ge": 20, "score": 2}], "phrase_patterns": ["(", "上升+"], "negate_if_contains": []})
    pts, hits = total("增长30%。上升升60%", r)
    assert pts == 7 and [h.keyword for h in hits] == ["增长>=20%", "上升升>=50%"]


def test_clauses():
    assert clause_at("甲。乙 丙  丁%；戊", 6) == "乙 丙 丁%"
    assert trimmed("□不适用 甲乙") == "甲乙" and trimmed("适用甲") == "" and trimmed("甲☑适用乙") == "甲"
    long = "a" * 2000
    assert len(clause_at(long, 1000)) == 802
    assert is_table("项目 1") and not is_table("一段普通的话。") and is_table("|" * 2 + "x" * 140)


def test_rules_file():
    assert RuleSet.from_json("").rules[0].phrase == "复合增长率"
    assert [r.phrase for r in RuleSet.from_json('{"cagr_rules": [{"phrase": "a"}, {"phrase": "b"}]}').rules] == ["a", "b"]
    assert RuleSet.from_json('{"cagr_rule": {"phrase": "c"}}').rules[0].phrase == "c"


def test_native_points_agree(spark):
    rng = random.Random(4)
    rows = [(i, round(rng.uniform(0, 400), rng.randint(0, 2))) for i in range(400)] + [(1000, 20.0), (1001, 19.99), (1002, 300.0)]
    df = spark.createDataFrame(rows, "i int, v double").withColumn("t", F.concat(F.lit("收入增长"), numbers.short_number(F.col("v")), F.lit("%。")))
    rule = GrowthRule(phrase="增长", cap=12, score_multiplier=0.5, negate_if_contains=())
    out = scored(df.withColumn("p", numbers.linear_points(F.col("v"), 0.1, 12, 20.0, 0.5)), "t", RuleSet((rule,))).collect()
    assert all((r.p or 0) == r.growth_total for r in out)
    assert all(r.growth_hits[0].keyword == f"增长={r.v:g}%" for r in out if r.growth_hits)


def _same(spark, texts, rules, industries=()):
    """Native scores against the rules in Python."""
    df = spark.createDataFrame([(i, t, list(industries)) for i, t in enumerate(texts)], "i int, t string, names array<string>")
    got = {r.i: (r.growth_total, [tuple(h) for h in r.growth_hits]) for r in scored(df, "t", rules, "names").collect()}
    for i, t in enumerate(texts):
        total_, hits = rules.score(t, industries)
        want = (total_, [(h.keyword, h.weight, h.count, h.polarity, h.context) for h in hits])
        assert got[i] == want, (t, got[i], want)


RULES = RuleSet(
    (
        GrowthRule(phrase="同比增长", cap=12, phrase_aliases=("增长",), neutralize_if_contains=("行业",), full_negate_if_contains=("亏损",), industry_multipliers=((("银行",), 0.15),)),
        GrowthRule(phrase="下降", polarity="neg", cap=6, window_chars=9, stop_chars="。!", phrase_patterns=("减少?了", "(")),
        GrowthRule(phrase="复合增长率", mode="thresholds", thresholds=((5, 1), (20, 3), (40.5, 8), (90, 0)), score_multiplier=0.5),
        GrowthRule(phrase="a.b\\E", enabled=False),
        GrowthRule(phrase="a.b\\E", min_pct=0.0, k=3.0),
    )
)


def test_native_equals_rules(spark):
    rng = random.Random(5)
    words = ["同比增长", "增长", "复合增长率", "下降", "减少了", "减了", "公司", "行业", "成本", "亏损", "□适用", "☑不适用", "不适用", "适用", "。", "；", ";", "！", ",", " ", "\n", "甲乙", "𠀀", "12%", "20.5%", "45 %", "7", "8.25%", "３0%", "300%", "a.b\\E", "0.125%", "1234567.5%", "123.4567%", "%"]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(500)] + ["", None, "同比增长20%", "增长" * 50 + "50%"]
    _same(spark, texts, RULES)
    _same(spark, texts[:100], RULES, ["股份制银行", " "])


def test_native_long_clauses(spark):
    rng = random.Random(6)
    long = lambda n: "".join(rng.choice("甲乙丙 ,，1%|") for _ in range(n))
    texts = [long(a) + "同比增长30%" + long(b) for a, b in [(700, 10), (10, 900), (900, 900), (399, 401), (2000, 0)]] + ["项目 " + "字" * 700 + "同比增长50%" + "字" * 300]
    texts += ["甲" * 5000 + "。同比增长20%。" + "增长" + "乙" * 219 + "9%", "增长30%" * 300 + "。" + "公司增长45%。" * 400]
    _same(spark, texts, RULES)


def test_native_has_no_python(spark):
    plan = scored(spark.createDataFrame([("x",)], "t string"), "t", RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_repeats(spark):
    rows = [(i, t, n) for i, (t, n) in enumerate([("增长50%", ["银行"]), ("增长50%", None), (None, None), ("增长50%", ["银行"]), ("x", [])] * 3)]
    df = spark.createDataFrame(rows, "i int, t string, names array<string>")
    assert sorted(scored(df, "t", RULES, "names", repeats=True).collect()) == sorted(scored(df, "t", RULES, "names").collect())


def test_no_rules(spark):
    assert scored(spark.createDataFrame([("增长50%",)], "t string"), "t", RuleSet(())).first()[1:] == (0, [])


def test_rows_of_documents(spark):
    rng = random.Random(7)
    words = ["同比增长", "增长", "下降", "减少了", "复合增长率", "公司", "行业", "成本", "亏损", "□适用", "不适用", " ", "甲", "12%", "20.5%", "45 %", "300%", "20.0000001%"]
    parts = ["".join(rng.choice(words) for _ in range(rng.randrange(0, 9))) + "。" for _ in range(60)]
    rows = [(d, i, rng.choice(parts)) for d in range(120) for i in range(rng.randrange(0, 7))] + [(200, 0, None), (201, 0, "增长50%。"), (201, 1, None)]
    df = spark.createDataFrame(rows, "d int, i int, t string")
    docs = spark.createDataFrame([(d, "".join(t or "" for k, _, t in rows if k == d)) for d in sorted({r[0] for r in rows})], "d int, t string")
    want = sorted((r.d, r.growth_total, r.growth_hits) for r in scored(docs, "t", RULES).collect() if r.growth_hits)
    assert sorted(map(tuple, scored_rows(df, "d", "t", RULES, "i").collect())) == want and len(want) > 60
    kept = growth.MAX_BROADCAST
    try:
        growth.MAX_BROADCAST = 0
        assert sorted(map(tuple, scored_rows(df, "d", "t", RULES, "i").collect())) == want
    finally:
        growth.MAX_BROADCAST = kept


def test_rows_are_judged_once(spark):
    """growth_dedupe_agg: no filter of the plan looks for mentions, as that would be done for each row and again for what is left."""
    d = "/root/testdata/sf0.001"
    plan = catalog.growth_dedupe_agg(spark, d)._jdf.queryExecution().optimizedPlan().toString()
    filters = [ln for ln in plan.splitlines() if ln.strip(" :+-").startswith("Filter")]
    assert "Aggregate" in plan and not [ln for ln in filters if "transform" in ln]
