"""Long lines of pages take linear time, and lines with a title are the same as by a scan from every place."""

import random
import re
import time

from pyspark.sql import functions as F

from folioscope.operators import chapters as C


def test_long_lines_take_linear_time(spark):
    df = spark.range(1).select(F.concat(F.repeat(F.lit("字 x"), 150_000), F.lit("\n第三节 管理层讨论与分析")).alias("t"))
    began = time.monotonic()
    assert df.select(C.has_title(F.col("t"))).collect()[0][0]
    assert time.monotonic() - began < 20


def plain(t: str) -> bool:
    dense = lambda x: re.sub(r"\s+", "", x)
    if re.search(C.NAMES_IT, dense(t)) and re.search(f"{C.POINTS}|{C.CAUTIONS}", dense(t)):
        return False
    within = r"第三节\s*" + C.TITLE
    line, around = re.search(rf"[^\n]*{within}[^\n]*", t), re.search(rf"(?s).{{0,30}}{within}.{{0,30}}", t)
    own = any(re.search(C.TITLE_LINE, dense(x)) for x in t.split("\n"))
    return own or bool(line and not re.search(C.QUOTES, line[0]) and len(dense(line[0])) <= 60 and not re.search(C.POINTS, dense(around[0])))


def test_titles_within_lines(spark):
    r = random.Random(3)
    parts = ["第三节", "管理层讨论与分析", "经营情况讨论和分析", "\n", "\r", "\u2028", " ", "字" * 25, "“", "甲"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(1, 14))) for _ in range(3000)]
    got = [x[0] for x in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(C.has_title(F.col("t"))).collect()]
    assert got == [plain(t) for t in texts] and 100 < sum(got) < 2900


def test_words_before_expressions_change_nothing(spark):
    """A flag with a search of words before its expression is what the expression alone says."""
    r = random.Random(4)
    parts = ["第三节", "第 四 节", "第4节", "节", "管理层讨论与分析", "讨", "论", "\n", " ", "　", "目 录", "释义", "词汇表", "名词解释", "备查文件目录", "......", "…………", "·" * 6, "12", "业务概述", "一、", "报告期内公司从事的主要业务", "十二、报告期内接待调研", "市值管理", "13.", "公司治理", "04", "非经常性损益", "分季度主要财务指标", "报告期内公司所从事的主要业务、经营模式", "主要业务"]
    docs = [["".join(r.choice(parts) for _ in range(r.randrange(0, 7))) for _ in range(40)] for _ in range(60)]
    df = C.paged(spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, pages array<string>"), "id").where("text <> ''")
    t = F.col("text")
    leaders = F.size(F.filter(F.split(t, "\n"), lambda ln: ln.rlike(C.LEADER)))
    is_list = t.rlike(C.LISTS) | (leaders >= 3) | (F.regexp_count(t, F.lit(C.ITEM)) >= 8)
    assert df.where(C.is_list(t) != is_list).count() == 0 and df.where(is_list).count() > 50
    for p, words in ((C.ANCHOR, ["业务"]), (C.NEAR_ANCHOR, ["业务"]), (C.LATER, ["节", "公司治理", "接待调研", "市值管理"]), (C.FIGURES, C.FIGURES.split("|"))):
        assert df.where(t.rlike(p) & ~C._has(t, *words)).count() == 0 and df.where(t.rlike(p)).count() > 50
