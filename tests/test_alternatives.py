"""Overviews hold the whole text, whatever stands in it, as in their SQL."""

import pytest

from folioscope.operators import extract as E
from folioscope.plans import catalog
from tests import oracle

BLANKS = [c for c in map(chr, range(0x3001)) if c.isspace()]
HEADINGS = ["目 录", "释义", "词汇表", "第一章", "董事长致辞", "第二章 董事会报告", "董事会报告书", "第三节 管理层讨论与分析", "公司治理", "重要事项", "管理层综述", "业务展望"]


@pytest.mark.parametrize(
    "texts",
    [
        ["", " ", "\n\t\r", None, "a"],
        [t for c in BLANKS for t in (c, f"{c}a", f"a{c}", f"a{c} ", f"a {c}\n{c}b")],
        [t for c in BLANKS for t in ("a" * 69_993 + c + "bb", "a" * 69_992 + " " + c + "bb", "a" * 69_993 + c, "a" * 69_990 + c * 9)],
        [t for h in HEADINGS for t in (h, f"a\n{h}\nb", f"a\n  {h} b\n{h}", f"{h}\n{h}")] + ["a\n" + "\n".join(HEADINGS) + "\nb", "\ufdd0a\n\ufdd6", "a\0b😀\n公司治理" * 9000],
    ],
    ids=["blank", "white space", "cut", "headings"],
)
def test_whole_texts(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    name = "alternative_reports"
    assert oracle.difference(spark, oracle.connection(tmp_path), str(tmp_path), catalog.QUERIES[name], catalog.ORACLE_SQL[name]) is None


def test_blanks_are_white_space_unless_told():
    text = "管理层综述\n甲\u3000\n公司治理"
    assert [E.alternative_sections(text, *b)["business"] for b in ((), ("\n",))] == ["管理层综述\n甲", "管理层综述\n甲\u3000"]
