"""Functions of one text hold few rows in Python at a time, so a worker's memory does not grow with a task's rows."""

import pytest
from pyspark.sql import functions as F

from folioscope.functions.unicode import compatible
from folioscope.operators import chapters as C
from folioscope.operators import reading as R
from folioscope.operators import sections as S


@pytest.mark.parametrize(
    "apply",
    [
        lambda df: df.select(compatible(F.col("t"))),
        lambda df: df.select(C.letter_of(F.col("t"))),
        lambda df: S.applied(df, "t", {"a": lambda t: t[:1], "b": lambda t: None}),
        lambda df: df.select(R.preprocessed(F.col("t"))),
    ],
)
def test_no_arrow_batches(spark, apply):
    plan = apply(spark.createDataFrame([("x",)], "t string"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_applied_gives_nulls_and_texts(spark):
    df = S.applied(spark.createDataFrame([(1, "ab"), (2, None)], "i int, t string"), "t", {"a": lambda t: t[:1], "b": lambda t: None})
    assert sorted(map(tuple, df.collect())) == [(1, "ab", "a", None), (2, None, None, None)]
