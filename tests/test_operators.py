"""Relational operators: ties, nulls, empty tables, precedence; text functions; sources, sinks and windows."""

import json
import random
import re
import zipfile
from datetime import date, datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from folioscope.functions import keys, text, times
from folioscope.operators import digest, latest, lookup, merge, search, sections, tree
from folioscope.sources import feeds, readers, schemas, sinks
from folioscope.streaming import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} {'string' if isinstance(v, str) or v is None else 'int'}" for n, v in cols.items())) if names else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_dedupe_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", None, 3), ("b", None, 4), ("c", 5, 5)], "k string, t int, o int")
    assert rows(latest.dedupe(df, ["k"], F.col("t"), "o", "last").select("o")) == [(2,), (4,), (5,)]
    assert rows(latest.dedupe(df, ["k"], F.col("t"), "o", "first").select("o")) == [(1,), (3,), (5,)]
    assert latest.dedupe(df.limit(0), ["k"], F.col("t"), "o").count() == 0


def test_global_latest(spark):
    df = spark.createDataFrame([("a", 2020, 1), ("a", 2021, 2), ("b", None, 3)], "k string, y int, id int")
    order = [F.col("y").desc_nulls_last(), F.col("id").desc()]
    assert rows(latest.globally_latest(df.where("id <> 2"), df, "k", order, "id").select("id")) == [(3,)]


def test_latest_skips_blank_keys(spark):
    df = spark.createDataFrame([(" ", 1, 1), ("a", 1, 2), ("a", None, 3)], "k string, y int, id int").withColumns({"p": F.lit(None).cast("date"), "c": F.lit(None).cast("timestamp")})
    assert rows(latest.latest_per_key(df, "k", "y", "p", "c", "id").select("id")) == [(2,)]


def test_compressed_runs(spark):
    df = spark.createDataFrame([("d", i, 2 <= i < 14) for i in range(16)], "d string, i int, f boolean")
    out = latest.compressed_runs(df, ["d"], "i", F.col("f"))
    assert rows(out.select("i", "dropped")) == sorted([(i, 6 if i == 4 else 0) for i in (0, 1, 2, 3, 4, 11, 12, 13, 14, 15)], key=str)


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, keep string")
    s = spark.createDataFrame([(2, "c", 1), (2, None, 2), (3, "d", 3)], "id int, v string, o int")
    new = merge.upsert(t, s, ["id"], ordinal="o")
    assert rows(new) == [(1, "a", "x"), (2, None, "y"), (3, "d", None)]
    assert rows(merge.upsert(new, s, ["id"], ordinal="o")) == rows(new)
    assert rows(merge.upsert(t.limit(0), s, ["id"], ordinal="o")) == [(2, None, None), (3, "d", None)]


def test_replace_update_delete(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    s = spark.createDataFrame([(1, "z")], "k int, v string")
    assert rows(merge.replace_by_key(t, s, "k")) == [(1, "z"), (2, "c")]
    assert rows(merge.update_by_key(t, s, "k", ["v"])) == [(1, "z", True), (1, "z", True), (2, "c", False)]
    assert rows(merge.delete_by_key(t, s, ["k"])) == [(2, "c")]
    up, new = merge.split_by_presence(t, s, ["k"])
    assert (up.count(), new.count()) == (2, 1)


def test_lookup_takes_whole_records(spark):
    k = spark.createDataFrame([("1",), ("2",), ("3",)], "code string")
    a = spark.createDataFrame([("1", "x", None), ("2", " ", "")], "code string, l1 string, l2 string")
    b = spark.createDataFrame([("1", "p", "q"), ("2", "r", "s")], "code string, l1 string, l2 string")
    assert rows(lookup.chained(k, "code", [("a", a), ("b", b)], ["l1", "l2"])) == [("1", "x", None, "a"), ("2", "r", "s", "b"), ("3", None, None, None)]
    assert rows(lookup.chained(k, "code", [("a", a), ("b", b)], ["l1", "l2"], "all")) == [("1", "p", "q", "b"), ("2", "r", "s", "b"), ("3", None, None, None)]
    assert rows(lookup.name_backfill([a.select("code", F.lit("").alias("l1")), b], "code", "l1")) == [("1", "p"), ("2", "r")]


def test_masking(spark):
    words = text.dictionary([("ab", 2, "pos"), ("b", 1, "neg"), ("abc", 5, "pos")])
    hits = one(spark, text.masked_hits(F.col("t"), words), t="abcabb")
    assert [(h.keyword, h["count"]) for h in hits] == [("abc", 1), ("ab", 1), ("b", 1)]
    assert one(spark, text.points(text.masked_hits(F.col("t"), words)), t="abcabb") == 8
    assert [(h.keyword, h["count"]) for h in one(spark, text.plain_hits(F.col("t"), words), t="a bcabb")] == [("abc", 1), ("ab", 2), ("b", 3)]
    assert one(spark, text.masked_hits(F.col("t"), words), t=None) == []


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, text.merged_sections([F.lit(" "), F.lit(None).cast("string")], t), t="x") == "x"
    assert one(spark, text.merged_sections([F.lit("a"), F.lit("b")], t), t="x") == "a\n\nb"
    assert one(spark, text.truncated(t, 3), t="ab cd") == "ab\n\n[...TRUNCATED...]"
    assert one(spark, text.normalized(t), t="12\n3/4\nA b\n\n甲股份有限公司2023年年度报告\n---\r\n好") == "Ab\n好"
    assert one(spark, text.letter_text(t), t="甲\n\n\n\n乙  丙\n7") == "甲\n\n乙 丙"
    assert "​" in one(spark, text.reading_text(t), t="x" * 40)
    assert one(spark, text.without_toc(t), t="一 总则 ..... 12\n短 5\n年 2023\n正文") == "年 2023\n正文"
    assert one(spark, text.sentences_with(t, F.lit("b"), 2), t="a b。c。a  b！b?b") == "a b | b"
    assert one(spark, text.window_around(t, F.lit(50), 40), t="x" * 100) == "…" + "x" * 40 + "…"
    assert one(spark, text.xml_escaped(t), t="<a & 'b'>") == "&lt;a &amp; &apos;b&apos;&gt;"
    assert [one(spark, text.column_letter(F.lit(n))) for n in (1, 26, 27, 702, 703)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert one(spark, text.has_all_characters(t, F.lit("ba")), t="xxabxx") and not one(spark, text.has_all_characters(t, F.lit("bz")), t="ab")
    assert one(spark, text.paragraphs_xhtml(t), t="a\n\n<b") == "<p>a</p>\n<p>&lt;b</p>"


def test_reading_lines_of_all_documents(spark, tmp_path):
    from folioscope.plans import catalog

    rng = random.Random(4)
    bit = lambda: rng.choice(["x" * rng.choice([1, 4, 5, 19, 20, 21, 24, 25, 26, 44, 45, 46, 90]), "甲", " ", "\u200b", "\n", "a/b.c", "http://h.io/" + "q" * 30])
    rows = [(i, "".join(bit() for _ in range(rng.randint(1, 9)))) for i in range(400)] + [(900, None), (901, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    lines = lambda t: [s for ln in (t or "").split("\n") if (s := ln.strip(" "))]
    want = {i: "\n".join(re.sub("([!-~]{20})(?=[!-~]{5})", "\\1\u200b", s) for s in lines(t)) for i, t in rows}
    assert {r.doc_id: r.clean for r in catalog.QUERIES["reading_lines_whole"](spark, str(tmp_path)).collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert dict(con.execute(catalog.ORACLE_SQL["reading_lines_whole"]).fetchall()) == want


def test_codes(spark):
    c = F.col("c")
    assert [one(spark, keys.normal_code(c), c=x) for x in ("1", "SZ000002", "1234567", "x", None)] == ["000001", "000002", "1234567", None, None]
    assert [one(spark, keys.vendor_suffix_short(c), c=x) for x in ("900001", "920001", "600000", "000001")] == ["900001.SH", "920001.BJ", "600000.SH", "000001.SZ"]
    assert one(spark, keys.nav_key(c), c="--") == "row" and one(spark, keys.row_key(c, F.lit(1)), c=None) == "-1"
    assert [one(spark, keys.title_year(c), c=x) for x in ("甲2023年年度报告", "2022 年报", "年度报告")] == [2023, 2022, None]
    assert not one(spark, keys.title_is_report(c), c="关于2023年年度报告的公告") and one(spark, keys.title_is_report(c), c="2023年年度报告关于")
    assert [one(spark, keys.market(c), c=x) for x in ("SZSE", "x sse", "?")] == ["SZ", "SH", None]


def test_times(spark):
    t = F.col("t")
    day = lambda s: one(spark, times.to_day(t), t=s)
    assert [day(s) for s in ("2024-3-7", "2024/03/07", "2024.3.7", "20240307", "x", None)] == [date(2024, 3, 7)] * 4 + [None, None]
    assert one(spark, times.parsed(t), t="2024-01-02 03:04:05") == datetime(2024, 1, 2, 3, 4, 5) == one(spark, times.parsed(t), t="2024-01-02T03:04:05")
    assert one(spark, times.week_label(times.to_day(t)), t="2024-12-30") == "2025-W01"
    assert one(spark, times.sunday_week_label(times.to_day(t)), t="2024-12-29") == "2025-W01"
    assert one(spark, times.from_epoch(F.lit(1_700_000_000_000))) == one(spark, times.from_epoch(F.lit(1_700_000_000)))
    assert one(spark, times.crosses(F.lit(date(2024, 1, 31)), F.lit(date(2024, 2, 1)), "month"))


def test_digest_parts(spark):
    d = digest.parsed_details(F.col("t"), 2)
    got = one(spark, d, t="a|3|x|c c\nb|1|2|cc\n\nd|-2|4|\ne|5|6|")
    assert [(h.label, h.weight, h["count"]) for h in got] == [("a", 3, 0), ("d", -2, 4)]
    assert not one(spark, digest.visible(F.lit(0), F.col("t")), t=" ") and one(spark, digest.visible(F.lit(0), F.col("t")), t="x")
    df = spark.createDataFrame([(1, None, "b"), (2, 5, "a"), (3, 5, "b"), (4, 0, "c")], "id int, s int, c string")
    assert [r.id for r in digest.ranked(df, digest.by_score(F.col("s"), F.lit(1), F.col("c")), 3).orderBy("rank").collect()] == [2, 3, 4]


def test_tree(spark):
    h = spark.createDataFrame([("d", i, lv, f"t{i}", i + 1) for i, lv in enumerate((1, 2, 4, 3, 2, 1))], "doc_id string, idx int, level int, title string, page int")
    p = tree.with_parents(h)
    assert [r.parent_idx for r in p.orderBy("idx").collect()] == [None, 0, 1, 1, 0, None]
    assert [(r.next_idx, r.end_page) for r in tree.with_ends(h, F.lit(9)).orderBy("idx").collect()] == [(5, 5), (4, 4), (3, 3), (4, 4), (5, 5), (None, 9)]
    assert [r.path for r in tree.with_paths(p).orderBy("idx").collect()][2:4] == ["t0 / t1 / t2", "t0 / t1 / t3"]
    assert [one(spark, tree.level_of(F.col("t")), t=x) for x in ("第三节 甲", "二、乙", "（一）丙", "3、丁", "戊")] == [1, 2, 3, 4, None]
    assert one(spark, tree.normal_title(F.col("t")), t="（一） 主要 业务：") == "主要业务"
    assert one(spark, tree.heading_score(F.lit(14.0), F.lit("甲"), F.lit(1))) == pytest.approx(0.9)


def test_search_cascade(spark):
    f = lambda a, b=None: one(spark, search.status(F.col("a"), F.col("b"), "ab c"), a=a, b=b)
    long = "x" * 60
    assert [f("zab　c"), f("", "ab c"), f("a bc" + long), f("a"), f(long + "c b a"), f(long)] == ["MATCH_EXACT", "MATCH_ALT", "MATCH_COMPACT", "NO_TEXT", "SUSPECT_SPLIT", "NOT_FOUND"]


REPORT = "前言\n一、主要业务\n甲\n（一）产品\n乙\n（二）市场\n丙\n二、行业情况\n丁\n三、未来发展\n戊\n十一、其他\n己\n十二、公司治理\n庚"


def test_sections(spark):
    assert sections.by_keywords(REPORT, ["主要业务"]) == "一、主要业务\n甲\n（一）产品\n乙\n（二）市场\n丙" or sections.by_keywords(REPORT, ["主要业务"]).startswith("一、主要业务")
    assert sections.by_ordinal(REPORT, "二", words=()) == "二、行业情况\n丁"
    assert sections.to_next_bracket(REPORT, REPORT.index("\n（一）")) == "（一）产品\n乙"
    at = REPORT.index("\n十一、")
    assert sections.to_next_ordinal(REPORT, at, "十一", words=()) == "十一、其他\n己"
    assert sections.to_next_ordinal(REPORT, at, "十一", words=(), compat=True) != "十一、其他\n己"
    assert sections.next_ordinals("十") == ["十一", "11"] and sections.next_ordinals("20") == []
    assert sections.between("a S b E c", "S", ["E"]) == "S b" and sections.between("a", "S", []) is None
    assert sections.without_block("xS1Ey", "S", ["E"]) == "xEy"
    assert sections.titled("甲\n乙丙\n二、丁", "乙") == "乙丙"
    assert sections.to_next_titled(REPORT, 0, ["未来"]).endswith("丁") and sections.to_next_titled(REPORT, 0, ["没有"]) is None
    assert sections.placeholder("X").startswith("[PARSE_FAILED] reason=X")


def test_state_through_spark(spark, tmp_path):
    at = f"file://{tmp_path}/state.json"
    state = incremental.State(at, spark)
    assert state.get(incremental.SENT) is None
    state.put(incremental.SENT, datetime(2024, 5, 10, 12))
    state.put(incremental.CRAWL, datetime(2024, 5, 11))
    assert incremental.State(at, spark).get(incremental.SENT) == datetime(2024, 5, 10, 12) == incremental.State(f"{tmp_path}/state.json").get(incremental.SENT)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == ["state.json"]
    (tmp_path / "broken.json").write_text("{")
    assert incremental.State(f"file://{tmp_path}/broken.json", spark).get(incremental.SENT) is None


def test_windowed_counts(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 3), "a"), (datetime(2024, 1, 1, 9), "a"), (datetime(2024, 1, 2, 1), "a"), (datetime(2024, 1, 1, 1), None), (None, "a")], "ts timestamp, kind string")
    out = incremental.windowed_counts(rows, "ts", [F.col("kind")]).groupBy("kind").agg(F.sort_array(F.collect_list("n")).alias("n"))
    assert {r.kind: r.n for r in out.collect()} == {"a": [1, 2], None: [1]}


def test_outlook():
    body = "一、主要业务\n甲\n十一、公司未来发展的展望\n" + "二、战略\n" + "字" * 300
    assert sections.outlook(body + "\n（四）可能面对的风险\n险") == body[body.index("十一、") :]
    assert sections.outlook(body + "\n十二、报告期内接待调研\n访") == body[body.index("十一、") :]
    assert sections.outlook("一、未来规划\n短") is None and sections.outlook("一、未来规划\n短", 1) == "一、未来规划\n短" and sections.outlook("") is None


def test_sources(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿code,industry\n1,A\n2,\n1,B\n", encoding="utf-8")
    assert rows(readers.csv_map(spark, str(tmp_path / "m.csv"))) == [("000001", "B", None)]
    (tmp_path / "m.json").write_text(json.dumps({"data": {"1": ["A", "x"], "2": {"sw_l1": "B"}}}), encoding="utf-8")
    assert rows(readers.json_map(spark, str(tmp_path / "m.json"))) == [("000001", "A", "x"), ("000002", "B", None)]
    assert readers.json_or(str(tmp_path / "none"), 7) == 7
    for col in ("szse", "sse"):
        (tmp_path / "feed" / col).mkdir(parents=True)
        for n, stamps in enumerate(([50, 40], [30, 5], [4, 3]), 1):
            page = [{"announcementTitle": "甲2023年年度报告", "secCode": "000001", "secName": "甲", "announcementTime": s * 1000 + 1.7e12} for s in stamps]
            (tmp_path / "feed" / col / f"{n}.json").write_text(json.dumps(page), encoding="utf-8")
    spark.dataSource.register(feeds.PagedFeed)
    feed = spark.read.format("paged_feed").option("path", str(tmp_path / "feed")).option("start", 1.7e9 + 10).load()
    assert feed.count() == 8  # the third pages are not read
    start, end = (times.from_epoch(F.lit(1_700_000_000 + s)) for s in (30, 50))
    assert readers.candidates(feed, start, end, 2020).count() == 6
    with pytest.raises(ValueError):
        readers.to_score(feed)


def test_sinks(spark, tmp_path):
    tab = spark.createDataFrame([("a", "n", "9"), ("b", "m", None)], "key string, stock_name string, score string")
    new = spark.createDataFrame([("a", "N"), ("c", "k")], "key string, stock_name string")
    assert rows(sinks.sync_tab(tab, new)) == [("a", "N", "9"), ("b", "m", None), ("c", "k", None)]
    old = spark.createDataFrame([("a", "n", "i", "d", "p", "1", "x")], "key string, stock_name string, industry string, publish_date string, pdf_name string, score string, notes string")
    assert rows(sinks.migrated(old)) == [("a", "n", "i", None, None, "d", "p", "1", "x")]
    sinks.write_lists(spark.createDataFrame([("x", "A"), ("y", "B")], "value string, status string"), str(tmp_path / "lists"))
    assert (tmp_path / "lists" / "status=A").is_dir()
    sinks.write_epub(str(tmp_path / "d.epub"), "T", [("H", "a\n\n<b>")])
    with zipfile.ZipFile(tmp_path / "d.epub") as z:
        assert z.infolist()[0].filename == "mimetype" and z.infolist()[0].compress_type == zipfile.ZIP_STORED and b"&lt;b&gt;" in z.read("c0.xhtml")
    assert rows(sinks.key_rows(spark.createDataFrame([("a", 1), ("", 2), ("a", 3)], "key string, o int"), "o")) == [("a", 4)]
    assert spark.createDataFrame([], schemas.REPORTS).columns[:2] == ["id", "stock_code"]


def test_incremental(spark, tmp_path):
    state, now = incremental.State(str(tmp_path / "s.json")), datetime(2024, 5, 10, 12)
    assert incremental.digest_window(state, now) == (datetime(2024, 5, 10), now)
    df = spark.createDataFrame([(1, datetime(2024, 5, 10, 1)), (2, datetime(2024, 5, 10, 12)), (3, datetime(2024, 5, 11))], "id int, c timestamp_ntz")
    got = []
    run = lambda t, keep=lambda x: x: incremental.run_digest(df, state, t, "c", keep, lambda o: got.append(sorted(r.id for r in o.collect())))
    assert run(now, lambda x: x.where("id > 9")) == 0 and state.get(incremental.GENERATED) is None  # nothing left: the mark stays
    assert run(now) == 2 and run(datetime(2024, 5, 11)) == 1 and run(datetime(2024, 5, 11)) == 0
    assert got == [[1, 2], [3]]
    state.put(incremental.SENT, now)
    assert state.get(incremental.GENERATED) == datetime(2024, 5, 11)
    state.put(incremental.CRAWL, now)
    assert incremental.crawl_window(state, now, 7) == (datetime(2024, 5, 10, 11, 58), datetime(2024, 5, 11, 12))
    assert [r.period for r in incremental.slice_sizes(df, "c", "day").collect()] == ["2024-05-11", "2024-05-10"]
