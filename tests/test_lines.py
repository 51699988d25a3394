"""Lines keep their last digits, whatever their place, and lose the spaces around them."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions import numbers, text

LINES = [f" {chr(97 + n)} {n}{n}{' ' * (n % 2)}" for n in range(12)]


@pytest.mark.parametrize(("function", "between"), [(text.letter_text, " "), (text.normalized, "")])
def test_lines_are_trimmed_of_spaces_alone(spark, function, between):
    df = spark.createDataFrame([("\n".join(LINES),), (None,), ("",)], "t string")
    want = "\n".join(f"{chr(97 + n)}{between}{n}{n}" for n in range(12))
    assert [r[0] for r in df.select(function(F.col("t"))).collect()] == [want, "", ""]


def test_industries_are_trimmed_of_spaces_alone(spark):
    df = spark.createDataFrame([([" C10 "],), (["C1"],), (["x", "C1"],)], "i array<string>")
    got = df.select(numbers.industry_multiplier(F.col("i"), [(("C10",), 0.5)])).collect()
    assert [r[0] for r in got] == [0.5, 0.5, 0.5]  # one contains the other
    df = spark.createDataFrame([(["0"],), (["x", "1"],), (["x"],)], "i array<string>")
    got = df.select(numbers.industry_multiplier(F.col("i"), [(("0", "1"), 0.5)])).collect()
    assert [r[0] for r in got] == [0.5, 0.5, 1.0]
