"""Feeds as streams, daily snapshots, cached maps, providers and items, with failures and second runs."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from folioscope.sources import feeds, items, providers, sinks
from folioscope.sources.cached import CachedMap


def put(root, column, stamps, size=2, total=False):
    """A feed's pages, newest first."""
    (root / column).mkdir(parents=True, exist_ok=True)
    stamps = sorted(stamps, reverse=True)
    for n in range(0, len(stamps), size):
        rows = [{"announcementTitle": f"t{s}", "secCode": "1", "secName": "n", "announcementTime": s} for s in stamps[n : n + size]]
        (root / column / f"{n // size + 1}.json").write_text(json.dumps({"totalRecordNum": len(stamps), "announcements": rows} if total else rows), encoding="utf-8")


@pytest.mark.parametrize("total", [False, True])
def test_feed_stream(spark, tmp_path, total):
    spark.dataSource.register(feeds.PagedFeed)
    root, out, check = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        feed = spark.readStream.format("paged_feed").option("path", f"file://{root}").option("block", 2).option("start", 5).load()
        q = feed.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted((r.col, int(r.ts)) for r in spark.read.parquet(out).collect())

    put(root, "szse", range(1, 12), total=total)
    put(root, "sse", [20], total=total)
    first = [("sse", 20), *(("szse", s) for s in range(6, 12))]
    assert run() == first
    assert run() == first  # nothing new
    put(root, "szse", range(1, 20), total=total)
    second = sorted(first + [("szse", s) for s in range(12, 20)])
    assert run() == second
    (root / "sse" / "1.json").rename(tmp_path / "gone")  # the feed is down: the query stops, nothing is taken for empty
    with pytest.raises(Exception, match="no first page"):
        run()
    (tmp_path / "gone").rename(root / "sse" / "1.json")
    put(root, "sse", [20, 21], total=total)
    assert run() == sorted(second + [("sse", 21)])


def test_feed_blocks(tmp_path):
    put(tmp_path, "szse", range(1, 50), total=True)
    r = feeds.PagedReader({"path": str(tmp_path), "columns": "szse", "block": "4", "start": "44"})
    parts = r.partitions()
    assert [(p.first, p.last) for p in parts] == [(1, 4), (5, 8), (9, 12), (13, 16), (17, 20), (21, 24), (25, 25)]
    read = [[int(x[4]) for x in r.read(p)] for p in parts]
    assert read == [[49, 48, 47, 46, 45, 44]] + [[]] * 6  # blocks before the window end with their first page
    assert feeds.stored_json(str(tmp_path / "none.json"), 3) == 3
    assert feeds.stored_json(f"file://{tmp_path}/szse/25.json", 0)["announcements"][0]["announcementTime"] == 1


def test_snapshot(spark, tmp_path):
    path, run_date = str(tmp_path / "tabs"), F.lit(date(2024, 3, 10))
    schema = "key string, stock_name string, publish_date date, score string, notes string"
    day = lambda rows: sinks.snapshot(spark.createDataFrame(rows, schema), run_date)
    read = lambda: sorted((r.tab, r.key, r.stock_name, r.notes) for r in sinks.read_tabs(spark, path).collect())
    sinks.sync_snapshot(day([("a", "A", date(2024, 3, 1), None, None), ("b", "B", None, None, "mine")]), path)
    assert read() == [("3.1", "a", "A", None), ("3.10", "b", "B", "mine")]
    again = day([("b", "BB", date(2023, 3, 10), None, "other"), ("c", "C", None, None, None)])
    for _ in range(2):  # the second run changes nothing
        sinks.sync_snapshot(again, path)
        assert read() == [("3.1", "a", "A", None), ("3.10", "b", "BB", "mine"), ("3.10", "c", "C", None)]


def test_cached_map(spark, tmp_path):
    cache = CachedMap(spark, f"file://{tmp_path}/map")
    t = datetime(2024, 5, 1, 12)
    assert cache.load() is None and cache.info() == {}
    one = spark.createDataFrame([("1", "A")], "code string, l1 string")
    assert [tuple(r) for r in cache.refreshed(lambda: one, "first", t).collect()] == [("1", "A")]
    held = cache.load()

    def fails():
        raise OSError("no network")

    assert cache.refreshed(fails, "second", t).count() == 1 and cache.info()["source"] == "first"
    assert cache.refreshed(lambda: one.limit(0), "second", t).count() == 1 and cache.info()["source"] == "first"  # nothing is no map
    two = spark.createDataFrame([("1", "B"), ("2", "C")], "code string, l1 string")
    assert cache.refreshed(lambda: two, "second", t + timedelta(days=1)).count() == 2
    assert cache.info() | {"version": 0} == {"version": 0, "updated_at": "2024-05-02 12:00:00", "source": "second", "count": 2}
    assert held.collect()[0].l1 == "A"  # readers keep their version
    assert cache.load(t + timedelta(days=3), timedelta(days=1)) is None and cache.load(t + timedelta(days=2), timedelta(days=1)).count() == 2
    bad = spark.createDataFrame([("x",)], "v string").select(F.raise_error(F.col("v")).alias("v"))
    assert cache.refreshed(lambda: bad, "third", t).count() == 2 and cache.info()["source"] == "second"  # a write that dies switches nothing


class _Known(providers.KeyedReader):
    """Knows some keys, and notes what it was asked for."""

    def fetch(self, keys):
        with open(self.options["log"], "a") as f:
            f.write("".join(f"{k}\n" for k in keys))
        for k in keys:
            if k in self.options["known"].split(","):
                yield k, self.options["name"], None
            elif k.startswith("blank"):
                yield k, " ", None


def _provider(kind, known, log):
    class Source(DataSource):
        @classmethod
        def name(cls):
            return kind

        def schema(self):
            return "code string, l1 string, l1_code string"

        def reader(self, schema):
            return _Known({"known": known, "log": log, "name": kind})

    return Source


def test_providers_get_what_is_missing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(providers, "BLOCK", 3)
    logs = [tmp_path / n for n in ("one", "two", "three")]
    for log, known in zip(logs, ("a,b", "a,c,blank1", "d"), strict=True):
        log.touch()
        spark.dataSource.register(_provider(f"p_{log.name}", known, str(log)))
    keys = spark.createDataFrame([(k,) for k in ["a", "b", "c", "d", "e", "blank1", None, "a"]], "code string")
    names = [f"p_{log.name}" for log in logs]
    with pytest.raises(ValueError, match="filterPushdown"):
        providers.asked(keys, "code", names, ["l1", "l1_code"])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = providers.asked(keys, "code", names, ["l1", "l1_code"])
        assert sorted(map(tuple, got.collect())) == [("a", "p_one", None, "p_one"), ("b", "p_one", None, "p_one"), ("blank1", "p_two", None, "p_two"), ("c", "p_two", None, "p_two"), ("d", "p_three", None, "p_three")]
        assert [sorted(log.read_text().split()) for log in logs] == [["a", "b", "blank1", "c", "d", "e"], ["blank1", "c", "d", "e"], ["d", "e"]]
        assert providers.asked(keys.where("code = 'x'"), "code", names, ["l1"]).count() == 0
        with pytest.raises(Exception, match="read by code only"):
            spark.read.format("p_one").load().collect()
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


class _Failing(items.ItemWriter):
    def check(self, item, bodies):
        super().check(item, bodies)
        if item == "deadly":
            raise SystemExit("the task dies")


class _FailingItems(items.Items):
    @classmethod
    def name(cls):
        return "failing_items"

    def writer(self, schema, overwrite):
        return _Failing(self.options)


def test_items_whole_or_not(spark, tmp_path):
    spark.dataSource.register(items.Items)
    spark.dataSource.register(_FailingItems)
    at = f"file://{tmp_path}/items"
    make = lambda rows: spark.createDataFrame(rows, items.SCHEMA)
    read = lambda: sorted((r.item, r.bodies) for r in items.items(spark, at).collect())
    items.write_items(make([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z"), ("c", 1, "q"), ("c", 2, None)]), at)
    assert read() == [("a", ["x", "y"]), ("b", ["z"])]
    assert {r.item: r.reason for r in items.batches(spark, at).collect()} == {"a": None, "b": None, "c": "ValueError: a part is missing"}
    with pytest.raises(Exception, match="(?i)dies|exit|abort|fail"):  # a task dies after others have written: nothing is published
        items.write_items(make([("a", 1, "new"), ("deadly", 1, "x"), *[(f"i{k}", 1, "v") for k in range(20)]]), at, "failing_items")
    assert read() == [("a", ["x", "y"]), ("b", ["z"])] and len(list((tmp_path / "items" / "batches").glob("*.json"))) == 1
    items.write_items(make([("a", 1, "new"), ("c", 1, "q"), ("b", 1, None)]), at)  # the next run: the latest state of each item counts
    assert read() == [("a", ["new"]), ("c", ["q"])]
