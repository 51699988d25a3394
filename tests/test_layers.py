from folioscope.operators import layers


def test_field_wise(spark):
    rows = spark.createDataFrame([("a", 2, "x", 1), ("a", 1, None, 5), ("a", 1, None, 4), ("a", 3, "y", None), ("b", 1, None, None)], "k string, layer int, s string, i int")
    assert sorted(map(tuple, layers.field_wise(rows, ["k"], ["layer"], ["s", "i"]).collect())) == [("a", "x", 4), ("b", None, None)]


def test_chosen_rules(spark):
    rows = spark.createDataFrame([("a", "single", 1, {"x": "1"}), ("a", "list", 2, {"y": None}), ("a", "list", 3, {"z": "9"}), ("b", "single", 1, {"x": "1"}), ("c", "none", 5, {"x": "1"}), ("d", "list", 1, None)], "k string, kind string, no int, rule map<string,string>")
    got = {(r.k, r.no): r.rule for r in layers.chosen_rules(rows, "k", {"x": "0", "y": "0"}).collect()}
    default = {"x": "0", "y": "0"}
    assert got == {("a", 2): {"x": "0", "y": None}, ("a", 3): default | {"z": "9"}, ("b", 1): default | {"x": "1"}, ("c", 0): default, ("d", 0): default}
