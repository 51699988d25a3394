from datetime import date

from pyspark.sql import functions as F

from folioscope.operators import extract as E
from folioscope.sources.config import Settings

PAGES = ["x"] * 6 + ["第三节 管理层讨论与分析\n一、行业情况\n好\n二、主要业务\n多", "第四节 公司治理\n尾"]


def test_extracted(spark):
    letter = ["封面", "致股东\n各位股东：\n" + "好的。\n" * 200 + "张三 董事长 2024年3月20日", "目 录"]
    docs = [(1, PAGES), (2, None), (3, ["普通文字"]), (4, []), (5, [None, " "]), (6, letter + ["x"] * 4 + PAGES[6:]), (7, ["管理层综述\n综述\n公司治理\n尾"]), (8, ["字" * 99] * 30 + PAGES[6:]), (9, ["字" * 99] * 70 + PAGES[6:]), (10, ["字" * 99] * 70)]
    rows = {r.id: r for r in E.extracted(spark.createDataFrame(docs, "id int, pages array<string>"), "id", chars=5000).collect()}
    assert {i: r.status for i, r in rows.items()} == {1: E.OK, 2: E.EMPTY, 3: E.BROKEN, 4: E.EMPTY, 5: E.EMPTY, 6: E.OK, 7: E.OK, 8: E.OK, 9: E.SLOW, 10: E.SLOW}
    assert rows[1].full_mda == rows[8].full_mda == "管理层讨论与分析\n一、行业情况\n好\n二、主要业务\n多" == rows[1].business and rows[1].chairman_letter is None
    assert rows[6].chairman_letter.startswith("致股东") and rows[6].chairman_letter.endswith("好的。\n\n张三\n董事长\n2024年3月20日")
    assert rows[7].business == "管理层综述\n综述" and rows[3].full_mda == "[PARSE_FAILED] reason=FAILED"
    assert (rows[8].pages_read, rows[9].pages_read, rows[2].pages_read) == (32, 60, 0) and rows[9].full_mda.startswith("[PARSE_FAILED] reason=PARSE_TOO_SLOW\n字")


def test_alternatives():
    text = "目 录\n管理层综述 1\n第一章 概况\n管理层综述\n综述的内容\n第二章 董事会报告\n报告的内容\n第三章 其他\n2.3 业务展望与计划" + "字" * 60 + "\n公司治理\n尾"
    out = E.alternative_sections(text)
    assert "综述的内容" in out["business"] and "报告的内容" in out["business"] and out["business"].count("董事会报告") == 1
    assert out["future"].startswith("2.3 业务展望") and "公司治理" not in out["future"]
    assert E.alternative_sections("普通文字") is None and E.alternative_sections(None) is None


def test_frame(spark):
    df = spark.createDataFrame([(1, PAGES), (2, None), (3, ["a"])], "id int, pages array<string>")
    got = {r.id: (r.status, r.full_mda) for r in E.parsed_by(df, "id", "pages", lambda p: {"full_mda": p[6]}).collect()}
    assert got[1] == (E.OK, PAGES[6]) and got[2] == got[3] == (E.BROKEN, "[PARSE_FAILED] reason=IndexError: list index out of range")
    jobs = spark.createDataFrame([(1, True, 60), (2, True, 60), (3, False, 60), (4, True, 10)], "id int, exists boolean, pages int")
    done = spark.createDataFrame([(1,)], "id int")
    assert [r.id for r in E.parse_jobs(jobs, done, ["id"]).collect()] == [2] and E.parse_jobs(jobs, done, ["id"], again=True).count() == 2
    cases = spark.createDataFrame([(20, 800, 8, 1.0), (20, 9000, 8, 1.0), (10, 1000, 8, 31.0), (5, 0, 8, 50.0)], "i int, c int, p int, m double")
    assert [r.x for r in cases.select(E.image_heavy(F.col("i"), F.col("c"), F.col("p"), F.col("m")).alias("x")).collect()] == [True, False, True, False]


def test_settings(tmp_path):
    (tmp_path / "a.ini").write_text("[main]\nyears = 3\nworkers = x\nflag = yes\n[scoring]\ngood = 甲:3, 乙:-2,丙\n", encoding="utf-8")
    s = Settings(str(tmp_path / "a.ini"), {"threads": 4, "none": None})
    assert (s.get("threads", 1), s.get("workers", 8), s.get("flag", False), s.get("none", "d")) == (4, 8, True, "d")
    assert s.least_year(date(2025, 5, 1)) == 2023 and s.words("good") == {"甲": 3, "乙": -2}
