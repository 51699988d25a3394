from pyspark.sql import functions as F

from folioscope.functions.unicode import compatible


def test_compatible_forms(spark):
    df = spark.createDataFrame([("ＡＢ１​①",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(compatible(F.col("t"))).collect()] == ["AB11", None, ""]
