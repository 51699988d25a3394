"""Substring dedup: words that lie in a repeated window of 20 words are removed, but for its first occurrence.

Words are maximal runs of characters other than space and U+0009..U+000D. A window is 20 consecutive words of one document. A
window is repeated if the same words start at a smaller place, where places are (doc_id, number of the window's first word). Each
word that a repeated window covers is removed. Windows are judged on the input, not on what is left of it.

Plan: super-k-mers. The least hash of SEED consecutive words in a window is its minimiser. Consecutive windows that share one travel as
one packed string of all their words to the bucket of that minimiser, about nine windows in a string of 28 words, so equal windows
always meet. The CODES most frequent words are packed in two bytes each, others stand as they are after them: equal windows are
equal packed, and only they. Within a bucket windows are sorted and compared as they are, so hashes decide on places only, never on equality.
A string that a task has already sent from an earlier place is not sent again: it is a mark of repeated windows at once, so a text that a
third of all documents share comes to its bucket once for each task. Word sequences that are frequent in the whole corpus are
counted first and are minimisers only in windows that have nothing else, so a line that all documents share does not gather all
that stands around it in one bucket: windows that reach over its ends go where their rarer words send them.
Marks are grouped by document and meet its text again.

Defined results: null texts have no words; texts of under 20 words lose nothing; null ids come after all others; rows of one id are one
document for the order of places, each keeps its own result, and equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm._shared import kept, pick

WINDOW, SEED = 20, 3
#: Windows in one string at most: longer runs (one word again and again) are cut.
RUN = 64
#: Bytes of text that a task looks at together.
CHUNK = 4 << 20
#: A sequence of words is frequent from this share of all sequences on, or a share of 1 in SPREAD for each shuffle partition if that is less.
FREQUENT, SPREAD = 1 / 4096, 16
#: Words with a code of two bytes; OTHER stands for all others.
CODES = OTHER = 65_535
#: Ids of documents that are broadcast to leave texts without repeats out of a shuffle; more of them are joined.
MAX_BROADCAST = 1_000_000
#: The id that a null counts as.
LAST = (1 << 63) - 1

_SENT = pa.schema([("bucket", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("twice", pa.bool_()), ("body", pa.binary())])
_MARKS = pa.schema([("d", pa.int64()), ("h", pa.int64()), ("at", pa.int32()), ("n", pa.int32())])
_KEPT = pa.schema([("d", pa.int64()), ("missing", pa.bool_()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _keyed(docs: DataFrame) -> DataFrame:
    """d, h (together the key of a document), missing, text."""
    own = pick(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return own.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(text, F.col("doc_id").isNull()).alias("h"), F.col("doc_id").isNull().alias("missing"), text.alias("text"))


def seeds(words: list[bytes]) -> np.ndarray:
    """Hashes of each SEED consecutive words."""
    x = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    out = np.zeros(max(0, len(x) - SEED + 1), np.uint64)
    for i in range(SEED):
        out = (out ^ x[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out >> np.uint64(1)


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def runs(words: list[bytes], frequent: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
    """(minimiser, first window, number of windows, whether two of them may be equal) of each run of windows that travels as one string."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return
    x = seeds(words)
    order = np.argsort(x, kind="stable")
    again = x[order[1:]] == x[order[:-1]]
    last = np.full(len(x), -1)  # where the sequence of words at a place stood last
    last[order[1:][again]] = order[:-1][again]
    if len(frequent):
        near = np.minimum(np.searchsorted(frequent, x), len(frequent) - 1)
        x = x | ((frequent[near] == x).astype(np.uint64) << np.uint64(63))
    mins, places = least(x, WINDOW - SEED + 1), np.arange(n)
    new = np.concatenate(([True], mins[1:] != mins[:-1]))
    starts = np.flatnonzero((places - np.maximum.accumulate(np.where(new, places, 0))) % RUN == 0)
    twice = np.maximum.reduceat(last[:n], starts) >= starts
    yield from zip(mins[starts].astype(np.int64).tolist(), starts.tolist(), np.diff(starts, append=n).tolist(), twice.tolist(), strict=True)


def _chunks(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Rows of about CHUNK bytes of text (the last column) at a time; a longer text comes alone."""
    rows, size = [], 0
    for b in batches:
        for row in zip(*[b.column(c).cast(pa.binary()).to_pylist() if c == "text" else b.column(c).to_pylist() for c in names], strict=True):
            if rows and size + len(row[-1]) > CHUNK:
                yield rows
                rows, size = [], 0
            rows.append(row)
            size += len(row[-1])
    if rows:
        yield rows


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for r in rows:
        part.append(r)
        if len(part) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part = []
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def statistics(keyed: DataFrame, share: float, spark: SparkSession) -> tuple[np.ndarray, list[bytes]]:
    """Hashes of the word sequences that make up at least ``share`` of all, and none of less than half of it; the words that get codes.

    Each chunk of texts reports the sequences of at least half the share within it (what others leave out adds up to half the share at most),
    and the words that it has more than a few times.
    """
    schema = pa.schema([("seed", pa.int64()), ("word", pa.binary()), ("n", pa.int64())])

    def count(batches):
        def found():
            for rows in _chunks(batches, ("text",)):
                texts = [t.split() for (t,) in rows]
                x = np.concatenate([seeds(ws) for ws in texts])
                values, times = np.unique(x, return_counts=True)
                heavy = times >= share / 2 * len(x)
                yield (None, None, len(x))
                yield from ((v, None, n) for v, n in zip(values[heavy].astype(np.int64).tolist(), times[heavy].tolist(), strict=True))
                words = Counter(w for ws in texts for w in ws)
                yield from ((None, w, n) for w, n in words.items() if n >= max(2, len(x) >> 17))

        return _batches(found(), schema)

    counts = keyed.select("text").mapInArrow(count, "seed long, word binary, n long").groupBy("seed", "word").agg(F.sum("n").alias("n"))
    counts = kept(counts, spark, "windows-counts")
    total = counts.where(F.col("seed").isNull() & F.col("word").isNull()).select("n").first()
    heavy = counts.where((F.col("n") >= share / 2 * (total[0] if total else 0)) & F.col("seed").isNotNull()).select("seed")  # 2 / share of them at most
    words = counts.where(F.col("word").isNotNull()).orderBy(F.desc("n"), "word").select("word").limit(CODES)
    return np.sort(np.array([r[0] for r in heavy.collect()], np.uint64)), [bytes(r[0]) for r in words.collect()]


def packed(words: list[bytes], codes: dict[bytes, int]) -> Callable[[int, int], bytes]:
    """A function of the first and the last word but one: the packed string of these words."""
    x = np.fromiter(map(codes.get, words, repeat(OTHER)), np.uint16, len(words))
    rest = [words[i] for i in np.flatnonzero(x == OTHER).tolist()]
    before = np.concatenate(([0], np.cumsum(x == OTHER))).tolist()
    line = x.tobytes()
    return lambda a, b: line[2 * a : 2 * b] + b" ".join(rest[before[a] : before[b]])


def windows(body: bytes, n: int) -> list[bytes]:
    """The n windows of a packed string of n + WINDOW - 1 words."""
    long = 2 * (n + WINDOW - 1)
    line, codes = body[:long], memoryview(body[:long]).cast("H").tolist()
    if len(body) == long:
        return [line[2 * i : 2 * (i + WINDOW)] for i in range(n)]
    rest, before = body[long:].split(b" "), [0, *accumulate(c == OTHER for c in codes)]
    return [line[2 * i : 2 * (i + WINDOW)] + b" ".join(rest[before[i] : before[i + WINDOW]]) for i in range(n)]


def _sent(keyed: DataFrame, frequent: np.ndarray, coded: list[bytes]) -> DataFrame:
    def strings(batches):
        def found():
            codes = {w: i for i, w in enumerate(coded)}
            for rows in _chunks(batches, ("d", "h", "text")):
                seen: dict[bytes, tuple[int, int]] = {}
                for d, h, text in sorted(rows, key=lambda r: r[:2]):
                    words = text.split()
                    if len(words) < WINDOW:
                        continue
                    pack = packed(words, codes)
                    for bucket, at, n, twice in runs(words, frequent):
                        body = pack(at, at + n + WINDOW - 1)
                        if seen.setdefault(body, (d, at)) < (d, at):
                            yield (d ^ h, d, h, at, n, False, None)
                        else:
                            yield (bucket, d, h, at, n, twice, body)

        return _batches(found(), _SENT)

    return keyed.select("d", "h", "text").mapInArrow(strings, "bucket long, d long, h long, at int, n int, twice boolean, body binary")


def repeated(bucket: list[list]) -> Iterator[tuple[int, int, int, int]]:
    """(d, h, at, n) of repeated windows among a bucket's strings [d, h, at, n, twice, body]."""
    first: dict[bytes, tuple[int, int]] = {}
    for d, _, at, _, _, body in bucket:
        if body not in first or (d, at) < first[body]:
            first[body] = (d, at)
    single = len(first) == 1  # then windows can only be equal within the string
    each = []
    for k, (d, h, at, n, twice, body) in enumerate(bucket):
        if first[body] < (d, at):
            yield (d, h, at, n)
        elif twice or not single:
            each += [(w, d, at + i, k) for i, w in enumerate(windows(body, n))]
    each.sort()
    found: dict[int, list[int]] = {}
    now, least_place = None, None
    for w, d, at, k in each:
        if w != now:
            now, least_place = w, (d, at)
        elif least_place < (d, at):
            found.setdefault(k, []).append(at)
    for k, places in found.items():
        d, h, *_ = bucket[k]
        places.sort()
        begin = 0
        for i in range(1, len(places) + 1):
            if i == len(places) or places[i] != places[i - 1] + 1:
                yield (d, h, places[begin], i - begin)
                begin = i


def _marks(sent: DataFrame) -> DataFrame:
    def judge(batches):
        def found():
            now, bucket = None, []
            for b in batches:
                key = b.column("bucket").to_numpy()
                same = key[1:] == key[:-1]
                near = np.concatenate(([True], same)) | np.concatenate((same, [True]))  # the ends may go on in other batches
                more = pc.or_(b.column("twice"), pc.is_null(b.column("body")))  # a string alone in its bucket needs no look
                for key, *row in zip(*[c.to_pylist() for c in b.filter(pc.or_(pa.array(near), more)).columns], strict=True):
                    if row[-1] is None:
                        yield tuple(row[:4])
                        continue
                    if key != now and bucket:
                        yield from repeated(bucket)
                        bucket = []
                    now = key
                    bucket.append(row)
            if bucket:
                yield from repeated(bucket)

        return _batches(found(), _MARKS)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(judge, "d long, h long, at int, n int")


def _without(keyed: DataFrame, marks: DataFrame, spark: SparkSession) -> DataFrame:
    """missing, d, n_words, n_removed, kept."""
    spans = marks.groupBy("d", "h").agg(F.collect_set(F.struct("at", "n")).alias("spans")).select("d", "h", "spans.at", "spans.n")
    spans = kept(spans, spark, "windows-marks")
    if spans.count() <= MAX_BROADCAST:  # texts without repeats stay where they are
        ids = F.broadcast(spans.select("d").distinct())
        rows = keyed.join(ids, "d", "left_semi").join(spans, ["d", "h"], "left")
        rest = keyed.join(ids, "d", "left_anti")
        rows = rows.unionByName(rest, allowMissingColumns=True)
    else:
        rows = keyed.join(spans, ["d", "h"], "left")
    rows = rows.select("d", "missing", "at", "n", "text")

    def cut(batches):
        def cleaned():
            for rows in _chunks(batches, ("d", "missing", "at", "n", "text")):
                for d, missing, at, n, text in rows:
                    words = text.split()
                    left = words
                    if at:
                        a, k = np.array(at), np.array(n)
                        depth = np.bincount(a, minlength=len(words) + 1) - np.bincount(a + k + WINDOW - 1, minlength=len(words) + 1)
                        left = [w for w, over in zip(words, np.cumsum(depth).tolist(), strict=False) if not over]
                    yield (d, missing, len(words), len(words) - len(left), b" ".join(left).decode())

        return _batches(cleaned(), _KEPT, 1000)

    return rows.mapInArrow(cut, "d long, missing boolean, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, text: a row for each document, its kept words with one space between."""
    spark = spark or docs.sparkSession
    keyed = _keyed(docs)
    share = min(FREQUENT, 1 / (SPREAD * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    marks = _marks(_sent(keyed, *statistics(keyed, share, spark)))
    doc_id: Column = F.when(~F.col("missing"), F.col("d"))
    return _without(keyed, marks, spark).select(doc_id.alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("text"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
w AS (SELECT row, doc_id, unnest(range(1, len(ws) - 18)) AS s, ws FROM d WHERE len(ws) >= 20),
g AS (SELECT row, doc_id, s, array_to_string(ws[s:s + 19], ' ') AS g FROM w),
r AS (SELECT row, s FROM (SELECT row, s, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, s) AS k FROM g) WHERE k > 1),
c AS (SELECT row, list(DISTINCT p) AS gone FROM (SELECT row, unnest(range(s, s + 20)) AS p FROM r) GROUP BY row),
m AS (SELECT row, map_from_entries(list((p, true))) AS gone FROM (SELECT row, unnest(gone) AS p FROM c) GROUP BY row),
k AS (SELECT doc_id, ws, CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, i: gone[i] IS NULL) END AS left_ FROM d LEFT JOIN m USING (row))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(left_) AS BIGINT) AS n_removed, sha256(array_to_string(left_, ' ')) AS kept_sha256 FROM k"""
