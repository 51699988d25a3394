"""The heading detector."""

from pyspark.sql import functions as F

from folioscope.operators import headings as H
from folioscope.operators import tree

SPANS = "doc string, page int, line int, span int, text string, size double"
OUTLINE = "doc string, place int, level int, title string, page int"


def test_sources(spark):
    spans = spark.createDataFrame(
        [
            ("a", 1, 3, 1, "第一节 ", 15.0), ("a", 1, 3, 2, "概况", 13.0), ("a", 1, 1, 0, "封面", 20.0), ("a", 1, 7, 0, "一、甲：", 10.0), ("a", 2, 1, 0, " 3. " + "长" * 30, None), ("a", 2, 2, 0, "2、" + "长" * 60, 9.0), ("a", 2, 3, 0, "", 9.0), ("a", 2, 4, 0, "（二）乙", 0.0),
            ("b", 1, 1, 0, "一、甲", 10.0), ("c", 1, 1, 0, "一、丙", 14.0), ("d", 1, 1, 0, "没有", 14.0), ("e", 1, 1, 0, "第一节概况", 14.0),
        ],
        SPANS,
    )
    outline = spark.createDataFrame([("b", 2, 2, "后", 3), ("b", 1, 1, " 第1节 前； ", 0), ("c", 1, 1, " ", 1), ("c", 2, 1, None, 1), ("f", 0, 1, "只有目录", 2)], OUTLINE)
    got = {}
    for r in H.detected(outline, spans, "doc").orderBy("doc", "idx").collect():
        got.setdefault(r.doc, []).append((r.level, r.title, r.plain, r.number, r.page, r.line_no, r.score, r.method))
    assert got == {
        "a": [(1, "第一节 概况", "第一节概况", "第一节", 1, 2, 0.8, "text_heading"), (2, "一、甲：", "一、甲", "一、", 1, 3, 0.7, "text_heading"), (3, "3. " + "长" * 30, "3." + "长" * 30, "3.", 2, 1, 0.6, "text_heading"), (3, "（二）乙", "（二）乙", "（二）", 2, 4, 0.7, "text_heading")],
        "b": [(1, "第1节 前；", "第1节前", "第1节", 1, 0, 1.0, "toc"), (2, "后", "后", None, 3, 0, 1.0, "toc")],
        "c": [(2, "一、丙", "一、丙", "一、", 1, 1, 0.9, "text_heading")],
        "f": [(1, "只有目录", "只有目录", None, 2, 0, 1.0, "toc")],
    }
    up = tree.with_parents(H.detected(outline, spans, "doc"), "doc").where("doc = 'a'").orderBy("idx").select("parent_idx").collect()
    assert [r[0] for r in up] == [None, 0, 1, 1]


def test_levels(spark):
    titles = {"第三节 甲": (1, "第三节"), "十、乙": (2, "十、"), "(三) 丙": (3, "(三)"), "12.丁": (3, "12."), "1.2.3 戊": (3, "1."), "己": (2, None)}
    df = spark.createDataFrame([(t,) for t in titles], "t string").select(H.level(F.col("t")).alias("l"), H.number(F.col("t")).alias("n"))
    assert [tuple(r) for r in df.collect()] == list(titles.values())


def test_empty(spark):
    assert H.detected(spark.createDataFrame([], OUTLINE), spark.createDataFrame([], SPANS), "doc").count() == 0
