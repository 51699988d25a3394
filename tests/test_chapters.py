"""Chapters and letters of paged reports."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from folioscope.operators import chapters as C
from folioscope.operators import letters as L

PAD = ["x"] * 6


def pages(spark, docs):
    return C.paged(spark.createDataFrame([(i, p) for i, p in enumerate(docs)], "id int, pages array<string>"), "id")


def found(spark, docs):
    return {r.id: r for r in C.chapters(pages(spark, docs), "id").collect()}


def test_titles(spark):
    yes = ["尾页\n第三节 管理层讨论与分析\n一、", "经营情况讨论和分析", "第三章管理层讨论与分析", "第 三 节  管理层讨论与分析", "前 第三节 管理层讨论与分析 公司概况", "第12节经营情况讨论与分析"]
    no = ["", "重要提示\n管理层讨论与分析", "请详见\n第三节 管理层讨论与分析", "见“第三节 管理层讨论与分析”", "《管理层讨论与分析》", "参阅第三节管理层讨论和分析", "管理层讨论与分析如下", "字" * 61 + "第三节管理层讨论与分析", None]
    df = spark.createDataFrame([(t,) for t in yes + no], "text string")
    assert [r.x for r in df.select(F.coalesce(C.has_title(F.col("text")), F.lit(False)).alias("x")).collect()] == [True] * len(yes) + [False] * len(no)


def test_lists(spark):
    yes = ["目 录", "名词解释", "甲 ...... 1\n乙 …………·· 22\n丙......3 ", "第一节 第二节 第三节 第四节 第5章 第6章 第七部分 第八节"]
    no = ["正文", "甲 ...... 1\n乙 ...... 2", "甲 ...... 1 元\n乙 ...... 2 元\n丙 ...... 3 元", "第一节 第二节"]
    df = spark.createDataFrame([(t,) for t in yes + no], "text string")
    assert [r.x for r in df.select(C.is_list(F.col("text")).alias("x")).collect()] == [True] * len(yes) + [False] * len(no)


def test_intervals(spark):
    title, core = "第三节 管理层讨论与分析", "\n三、报告期内核心竞争力分析\n强"
    got = found(
        spark,
        [
            PAD + [title + "\n甲", "乙", "第四节 公司治理\n尾"],
            PAD + ["请详见第三节“管理层讨论与分析”", "尾\n一、报告期内公司从事的主要业务\n甲", "公司治理、环境和社会"],  # phrase only
            PAD + ["目 录\n" + title, title + "\n非经常性损益", "业务\n一、业务概述\n甲"],  # list, then figures: the text begins later
            PAD + ["", None, title + "\n" + "甲" * 600 + core, "丁"],
            PAD[:5] + [title],  # too early
            PAD + ["x"] * 160 + [title, "主要业务\n甲"],  # too late for the title, not for the phrase
            PAD + [title + "\n第四节 x"],  # ends where it begins
            PAD + [title] + ["字"] * 200,
            PAD + [title + "\n甲\n" + "乙" * 600 + "\n二、主营业务分析\n丙"],
            [],
            None,
        ],
    )
    assert {i: (r.how, r.first_page, r.n_pages) for i, r in got.items()} == {0: ("title", 6, 2), 1: ("anchor", 7, 1), 2: ("title", 8, 1), 3: ("title", 8, 2), 5: ("anchor", 167, 1), 7: ("title", 6, 160), 8: ("title", 6, 1)}
    assert got[0].full_mda == got[0].business == "管理层讨论与分析\n甲\n乙" and got[1].full_mda == "一、报告期内公司从事的主要业务\n甲" and got[2].full_mda == "业务\n一、业务概述\n甲"
    assert got[3].full_mda.endswith("丁") and got[3].business == "管理层讨论与分析\n" + "甲" * 600
    assert got[8].business.endswith("乙" * 600)


def loop(ps):
    """The located pages, page by page."""
    ok = lambda p, *names: p < len(ps) and ps[p] is not None and all(flag(ps[p], n) for n in names)
    flag = lambda t, n: {"t": bool(re.search(r"^第三节 管理层讨论与分析$", t, re.M)) and "详见" not in t, "list": "目录" not in t, "a": "报告期内公司从事的业务" in t, "later": "第四节" in t, "figures": "非经常性损益" not in t}[n]
    start = next((p for p in range(6, 160) if ok(p, "t", "list")), None)
    if start is None:
        start = next((p for p in range(6, 180) if ok(p, "a", "list")), None)
    if start is None:
        return []
    start = next((p for p in range(start, start + 12) if ok(p, "list", "figures") and (ok(p, "t") or "报告期内公司从事的业务情况" in ps[p])), start)
    out = []
    for p in range(start, start + 160):
        if ok(p, "later"):
            break
        if p < len(ps) and ps[p]:
            out.append(p)
    return out


def test_equals_a_loop(spark):
    r = random.Random(1)
    lines = ["第三节 管理层讨论与分析", "详见", "目录", "报告期内公司从事的业务", "报告期内公司从事的业务情况", "第四节", "非经常性损益"] + ["字"] * 9
    docs = [[None if r.random() < 0.05 else "\n".join(r.choice(lines) for _ in range(r.randrange(4))) for _ in range(r.choice([3, 9, 30, 190]))] for _ in range(150)]
    got = {}
    for row in C.located(pages(spark, docs), "id").collect():
        got.setdefault(row.id, []).append(row.page)
    want = {i: w for i, d in enumerate(docs) if (w := loop(d))}
    assert len(want) > 50 and {i: sorted(p) for i, p in got.items()} == want


def test_one_exchange(spark):
    plan = C.chapters(pages(spark, [["x"]]), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


BODY = "字" * 450


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (f"封面\n致股东\n各位：\n{BODY}\n张三 董事长 2024年3月20日\n第一节 甲", f"致股东\n各位：\n{BODY}\n\n张三\n董事长\n2024年3月20日"),
        (f"尊敬的各位股东：\n一\n{BODY}\n\n某某股份有限公司董事会\n\n二〇二四年三月\n重要提示\n尾", f"尊敬的各位股东：\n一\n{BODY}\n\n某某股份有限公司\n董事会\n\n二〇二四年三月"),
        (f"董事长致辞 ...... 3\n董事长致辞\n甲\n{BODY}", f"董事长致辞\n甲\n{BODY}"),
        (f"目录\n甲 1\n董事长致辞\n乙\n{BODY}\n公司简介\n丙", f"董事长致辞\n乙\n{BODY}"),
        (f"致股东\n短\n第一节 x\n主席致辞\n甲\n{BODY}", f"主席致辞\n甲\n{BODY}"),
        ("董事长致辞 ........ 3\n正文", L.HINT),
        ("致股东\n短", None),
        ("", None),
        (None, None),
    ],
)
def test_letters(text, want):
    assert L.letter(text) == want


def test_long_letter_is_cut():
    got = L.letter("致股东\n" + "一二三四五六七八九\n" * 9000)
    assert got.count("\n\n[...TRUNCATED...]\n\n") == 1 and 57_000 < len(got) < 59_000


def test_many_marks_equal_brute_force():
    r = random.Random(2)
    for _ in range(30):
        t = "".join(r.choice(["\n致股东\n", "\n主席致辞", "\n第一节 x", "\n目 录\n", "字" * r.randrange(300), " \n", "\n公司简介 "]) for _ in range(60))
        ends = [m.start() for m in L._END.finditer(t)]
        want = []
        for m in L._BEGIN.finditer(t):
            b = min((e for e in ends if e > m.start() + 120 and e >= m.end()), default=len(t))
            if len(re.sub(r"\s", "", t[m.start() : b])) >= 400:
                want.append((m.start(), b))
        assert list(L.spans(t)) == want


@pytest.mark.parametrize("unit", ["致股东\n", "\n第一节 x\n致股东", "致股东 字字字字字\n", "目 录\n", "董事长\n", "\n \n", "致股东\n第一节\n", "第 "])
def test_long_texts(unit):
    began = time.thread_time()
    L.letter(unit * (1_000_000 // len(unit)))
    assert time.thread_time() - began < 5
