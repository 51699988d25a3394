from pyspark.sql import functions as F

from folioscope.functions.text import table_like
from folioscope.operators import reading as R


def test_fragments_and_ordinals():
    assert list(R.without_fragments(["甲", "乙", "一行比较长的文字"])) == ["甲  乙", "一行比较长的文字"]
    assert list(R.without_fragments(["2", "新能源业务的情况"])) == ["2、新能源业务的情况"]
    assert list(R.without_fragments(["（一）", "新能源业务的情况"])) == ["（一）新能源业务的情况"]
    assert list(R.without_fragments(["2", "3、新能源业务的情况"])) == ["2", "3、新能源业务的情况"]
    assert list(R.without_fragments(["x"] * 13)) == ["  ".join("x" * 12), "x"]


def test_paragraphs():
    assert R.paragraphs(["一、标题", "第一行没有", "结束。第二", "行。", "第三段", "", "第四段"]) == "一、标题\n\n第一行没有结束。第二行。\n第三段\n第四段"
    assert R.reflowed(None) is None and R.reflowed("") == ""


def test_tables():
    rows = [f"营业 {i} | 100,{i}" for i in range(12)]
    out = R.shortened_tables("前文。\n" + "\n".join(rows) + "\n后文。").split("\n")
    assert out == ["前文。", *rows[:3], R.OMITTED, *rows[-3:], "后文。"]
    assert R.shortened_tables("\n".join(rows[:9])) == "\n".join(rows[:9])
    assert R.shortened_tables("a\n\n\n\n\nb") == "a\n\n\nb" and R.shortened_tables(None) == ""


def test_native_rows_agree(spark):
    lines = ["", "a", "1 | 2", "正文。12 | 3", "123456 项", "12,3% x", "12 3", "甲乙丙丁戊己庚辛壬1", "x-1", "甲乙丙丁戊己庚辛壬癸", "1" * 60, "  ", "12-3"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, t string")
    got = [r.x for r in df.orderBy("i").select(table_like(F.col("t")).alias("x")).collect()]
    assert got == [R.table_row(x) for x in lines]


def test_frame(spark):
    df = spark.createDataFrame([("12\n一、标题的文字\n正文这里还没有\n到这里才完。",), (None,)], "t string")
    assert [r[0] for r in df.select(R.readable(F.col("t"))).collect()][0] == "一、标题的文字\n\n正文这里还没有到这里才完。"
    assert R.cleaned(df, "t").select("clean").first()[0] == "一、标题的文字\n正文这里还没有\n到这里才完。"
