"""Exact Jaccard self-join on word shingles by partitioning the universe (pigeonhole principle).

A document's set is its distinct 5-word shingles as 64-bit hashes. For two sets with
100 * |A n B| >= 80 * |A u B| the symmetric difference has at most (|A| + |B|) / 9 elements.

1. Exact copies are grouped by digest and stand for one set. A group is named by 64 bits of its 128-bit digest; digests
   that share those bits are looked for and get other names.
2. Sets are put in bands by size, each 1.25 times the last; a set meets those of its own band and of
   the band below. In a band all hashes are cut into m segments, a few more than the largest possible
   difference of two sets there. A difference of d elements touches at most d segments, so two similar sets
   agree on any subset of segments that is larger than their difference.
3. All segments of a set that hold elements are indexed; it probes a subset of them that is just large enough. Which one is
   decided by cost: the frequencies of segments in a bounded sample of documents. In bands
   of small sets a segment can also count twice: its one-deletion neighbourhood is indexed, and a probe
   that allows one difference stands for two. Costs never change the result.
   A probe takes some segments more than it needs, so similar sets share more than one key. Empty segments are no keys. The few sets
   whose elements fall into so few segments that a similar set could agree with them on empty ones alone are indexed by
   elements besides: by as many of their least hashes that similar sets have one of them in common.
4. Sets with fewer shared keys than any similar set would leave are dropped (not from buckets that a set with too few segments
   probes). Candidates: sets that share a key, at least one probing and one indexed. A bucket of n sets is not
   expanded into pairs: all are first verified against its hub (the set with the most shared keys), which settles
   groups of copies; what is left of a bucket gets another hub, PEELS times at most. Then there are pairs of sets in different
   components left. Similar ones must share a known number of elements of their differences to the hub, so they share one among
   the first few of those in a common order (rare ones first); pairs come from a join on the hub and such an element,
   in which one side leaves out the hub's largest component. Before sets move, pairs are tested by sketches (counts of elements
   in parts of the universe), whose distance bounds the difference from below.
5. Every candidate is verified on the full sets; components come from label propagation with pointer jumping.

Shuffled are keys and ids; sets and texts move for candidates only. Keys that are frequent in the sample are spread over SALTS
tasks; hubs come from aggregates that are joined back, so Spark may split a hot bucket. Nothing grows with the corpus on
the driver.

Defined results: a document with fewer than 5 words has its whole word sequence as one shingle; without
words (or text) it has none and is linked with nothing; rows of one doc_id with
different texts are judged each by its text; rows without doc_id are linked like others and get the smallest id
reachable, or null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm._shared import batches_of, kept, pick

WORDS = 5
#: Documents whose segments are counted to tell costs, and how often one must be seen there to cost anything.
SAMPLE, SEEN = 16_384, 4
#: Costs that are sent to the tasks at most.
MAX_COSTS = 200_000
#: Largest set that indexes one-deletion neighbourhoods.
DELETIONS = 40
CHUNK = 1 << 19
#: Rows that a worker gets at once: texts, or pairs of sets.
ROWS_AT_ONCE = 1000
#: Hubs that a bucket gets after its first one.
PEELS = 2
#: Keys that one in so many sampled documents has are spread over so many tasks.
HOT_SHARE, SALTS = 64, 64
#: A frequent key is XORed with its salt times this (63 bits at most).
SALT = 0x9E3779B97F4A7C
#: Digests that share their 64 bits with others; more than any corpus has (n * n / 2**65 of n texts).
MAX_CLASHES = 10_000
#: Ids (8 bytes each) that may be broadcast; more are shuffled.
MAX_BROADCAST = 1_000_000
#: Texts whose digests a task remembers to skip their copies.
REMEMBERED = 1_000_000

_U = np.uint64
_rng = np.random.default_rng(5)
_BYTE = _rng.integers(0, 1 << 64, 64 * 256, dtype=_U)
_ODD = _rng.integers(0, 1 << 63, 8, dtype=_U) * _U(2) + _U(1)
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_ZERO, _FIRST = np.zeros(1, _U), np.ones(1, bool)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _times(n: int, k: int) -> np.uint64:
    return _U(n * int(_ODD[k]) & (1 << 64) - 1)


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts, and the first word of each text (with one more at the end).

    data: bytes; text i is data[begins[i]:ends[i]], and a gap stands between texts.
    """
    solid = np.flatnonzero(~_IS_GAP[data])
    if not len(solid):
        return np.empty(0, _U), np.zeros(len(begins) + 1, np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(solid) > 1])
    lens = np.diff(np.r_[first, len(solid)])
    place = np.arange(len(solid)) - np.repeat(first, lens)
    val = _BYTE[((place & 63) << 8) | _LOW[data[solid]]]
    if lens.max() > 64:
        val = _mix(val + (place >> 6).astype(_U) * _ODD[7])
    words = _mix(np.add.reduceat(val, first) + lens.astype(_U) * _ODD[6])
    return words, np.searchsorted(solid[first], np.r_[begins, ends[-1:]], side="left")


def sets_of(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct shingle hashes) of each text; null counts as empty."""
    col = texts.cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(col.buffers()[2] or b"", np.uint8) if len(col) and col.buffers()[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + CHUNK, side="right")) - 1)
        j = min(j, len(col))
        lens = np.diff(offs[i : j + 1])
        begins = np.r_[0, np.cumsum(lens + 1)[:-1]]
        data = np.full(int(lens.sum()) + len(lens), 0x20, np.uint8)
        at = np.arange(int(lens.sum())) + np.repeat(np.arange(len(lens)), lens)
        data[at] = raw[offs[i] : offs[j]]
        words, first = word_hashes(data, begins, begins + lens)
        s = np.zeros(max(0, len(words) - WORDS + 1), _U)
        for k in range(WORDS):
            s += words[k : k + len(s)] * _ODD[k]
        s = _mix(s)
        for k in range(j - i):
            a, b = int(first[k]), int(first[k + 1])
            if b - a >= WORDS:
                own = np.sort(s[a : b - WORDS + 1])
                yield i + k, own[np.concatenate((_FIRST, own[1:] != own[:-1]))]
            elif b > a:
                short = (words[a:b] * _ODD[: b - a]).sum(dtype=_U, keepdims=True) + _times(b - a, 5)
                yield i + k, _mix(short)
            else:
                yield i + k, np.empty(0, _U)
        i = j


def _bands(limit: int = 1 << 31) -> np.ndarray:
    lows = [1]
    while lows[-1] < limit:
        lows.append(lows[-1] * 5 // 4 + 1)
    return np.array(lows, np.int64)


LOWS = _bands()


def band_of(n: int) -> int:
    return int(np.searchsorted(LOWS, n, side="right")) - 1


def _least_segments(band: int) -> int:
    high = int(LOWS[band + 1]) - 1
    return (high + high * 5 // 4) // 9 + 1


def segments(band: int) -> int:
    """Segments of a band: the largest difference of two sets that meet there, one, and some to choose from."""
    most = _least_segments(band)
    return most + (most // 8 + 1 if most > 1 else 0)


def room(band: int) -> int:
    """Differences that a probe allows for beyond those of a similar set."""
    high = int(LOWS[band + 1]) - 1
    return (0 if high < 14 else 2) if high <= DELETIONS else (segments(band) - _least_segments(band)) // 2


def shares(band: int) -> int:
    """Keys of a band that similar sets share at least: one, and one more for each segment beyond the needed ones
    (for every two, where a segment can count twice)."""
    return 1 + (room(band) // 2 if int(LOWS[band + 1]) - 1 <= DELETIONS else room(band))


def _values(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a set's elements, and the sums of those before each element (with one more at the end)."""
    g = _mix(s + _ODD[6])
    return g, np.concatenate((_ZERO, np.cumsum(g)))


def _keys(s: np.ndarray, band: int, values: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a set in a band's partition: sums by segment, sizes, each element's segment and value."""
    m = segments(band)
    seg = ((s >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
    g, before = values or _values(s)
    size = np.bincount(seg, minlength=m)
    ends = np.cumsum(size)  # a set is sorted, so a segment's elements stand together
    return before[ends] - before[ends - size], size, seg, g


def _named(sums: np.ndarray, seg: np.ndarray, band: int, kind: int) -> np.ndarray:
    return _mix(sums + seg.astype(_U) * _ODD[1] + _times(2 * band + kind, 2))


def _cost(keys: np.ndarray, hot: np.ndarray, freq: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    return np.where(hot[at] == keys, freq[at], 0)


def _probe(s: np.ndarray, band: int, most: int, hot: np.ndarray, freq: np.ndarray, of: tuple) -> tuple[np.ndarray, np.ndarray, int]:
    """Segments that a set probes in a band so that no set within ``most`` differences is missed.

    Returns the exact keys' segments, the keys that those need besides which allow one difference, and how many differences
    all segments of the set would stand: one each, two where they have several elements and the band counts twice.
    """
    sums, size, seg, g = of
    full = np.flatnonzero(size)
    exact = _named(sums[full], full, band, 0)
    once = _cost(exact, hot, freq)
    if int(LOWS[band + 1]) - 1 > DELETIONS:
        return full[np.argsort(once, kind="stable")[: most + 1 + room(band)]], np.empty(0, _U), len(full)
    less = _named(sums[seg] - g, seg, band, 0)
    twice = _cost(_named(sums[full], full, band, 1), hot, freq) + np.bincount(seg, weights=_cost(less, hot, freq), minlength=len(sums))[full]
    twice = np.maximum(twice + 0.5 + size[full] * 0.01, once)[size[full] > 1]  # a second difference costs some keys in any case
    order = np.argsort(np.concatenate((once, twice)), kind="stable")[: most + 1 + room(band)]
    ones, twos = full[order[order < len(full)]], full[size[full] > 1][order[order >= len(full)] - len(full)]
    return ones, np.concatenate((_named(sums[twos], twos, band, 1), less[np.isin(seg, twos)])), len(full) + len(twice)


#: PROBE: in the band below; OWN: in the set's own band, by one deletion; ELEMENT: an element of a set that has too few segments.
INDEXED, BOTH, PROBE, SIZE, OWN, ELEMENT = 0, 1, 2, 3, 4, 5
#: Added to a role: a probe of a set with too few segments to share as many keys as others; a frequent key.
SHORT, HOT = 8, 16


def rows_of(s: np.ndarray, hot: np.ndarray, freq: np.ndarray, split: np.ndarray = np.empty(0, _U)) -> tuple[np.ndarray, np.ndarray]:
    """Keys and roles of a set. split: frequent keys."""
    n = len(s)
    band = band_of(n)
    values = _values(s)
    own = _keys(s, band, values)
    size = own[1]
    full, most = np.flatnonzero(size), 2 * n // 9
    ones, more, stands = _probe(s, band, most, hot, freq, own)
    short = SHORT * (stands < most + 1 + room(band))
    role = np.zeros(len(size), np.int8)
    role[ones] = BOTH + short
    keys, roles = [_named(own[0][full], full, band, 0), more], [role[full], np.full(len(more), OWN + short, np.int8)]
    if int(LOWS[band + 1]) - 1 <= DELETIONS:
        several = size[own[2]] > 1
        gone = _named((own[0][own[2]] - own[3])[several], own[2][several], band, 1)
        keys.append(gone)
        roles.append(np.zeros(len(gone), np.int8))
    # without a common key all segments of both sets would have to differ
    few = stands <= most or 4 * len(full) <= n
    if band and n <= (high := int(LOWS[band]) - 1) * 5 // 4:
        below = _keys(s, band - 1, values)
        most = (n + high) // 9
        ones, more, stands = _probe(s, band - 1, most, hot, freq, below)
        more = np.concatenate((_named(below[0][ones], ones, band - 1, 0), more))
        keys.append(more)
        roles.append(np.full(len(more), PROBE + SHORT * (stands < most + 1 + room(band - 1)), np.int8))
        few |= stands <= most
    if few:
        least = s[: n - (4 * n + 4) // 5 + 1]
        keys.append(_mix(least + _times(3, 3)))
        roles.append(np.full(len(least), ELEMENT, np.int8))
    key, role = np.concatenate(keys), np.concatenate(roles)
    if len(split):
        role = role + HOT * _members(key, split).astype(np.int8)
    return key, role


_ROWS = "key long, node long, role byte"


def _emit(hot: np.ndarray, freq: np.ndarray, split: np.ndarray = np.empty(0, _U)):
    """Batches of node, text -> keys; besides a row for each set with its size in key, and over that (times 2**32 and 2**48)
    the numbers of keys that a similar set shares with it in its own band and in the one below."""

    def run(batches):
        met: set = set()
        for batch in batches:
            batch = _unmet(batch, met)
            nodes = batch.column(0).to_numpy(zero_copy_only=False)
            keys, ids, roles, n = [], [], [], 0
            for i, s in sets_of(batch.column(1)):
                k, r = rows_of(s, hot, freq, split) if len(s) else (np.empty(0, _U), np.empty(0, np.int8))
                band = band_of(len(s)) if len(s) else 0
                keys += [k, np.array([len(s) | shares(band) << 32 | shares(max(0, band - 1)) << 48], _U)]
                roles += [r, np.array([SIZE], np.int8)]
                ids.append(np.full(len(k) + 1, nodes[i], np.int64))
                n += len(k) + 1
                if n > 100_000:
                    yield _batch(keys, ids, roles)
                    keys, ids, roles, n = [], [], [], 0
            if n:
                yield _batch(keys, ids, roles)

    return run


def _unmet(batch: pa.RecordBatch, met: set) -> pa.RecordBatch:
    """The rows whose node has not come before."""
    rows = []
    for i, v in enumerate(batch.column(0).to_pylist()):
        if v not in met:
            rows.append(i)
            if len(met) < REMEMBERED:
                met.add(v)
    return batch if len(rows) == len(batch) else batch.take(pa.array(rows, pa.int64()))


def _batch(keys, ids, roles) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(np.concatenate(roles))], ["key", "node", "role"])


def _elements(batches):
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        for i, s in sets_of(batch.column(1)):
            yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(np.full(len(s), nodes[i]))], ["key", "node"])


def _frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys that SEEN rows or more have, MAX_COSTS of them at most, sorted, and how many have them."""
    found = rows.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= SEEN).orderBy(F.desc("f"), "key").limit(MAX_COSTS).collect()
    keys, freq = np.array([r["key"] for r in found], np.int64).view(_U), np.array([r["f"] for r in found], float)
    order = np.argsort(keys)
    return keys[order], freq[order]


def sketch(s: np.ndarray) -> np.ndarray:
    """Elements in each of equal parts of the universe (255 counts for more), as many parts as half the elements or so."""
    bits = min(12, max(5, int(len(s)).bit_length() - 1))
    return np.minimum(np.bincount((s >> _U(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """Two sets with these sketches differ in so many elements at least."""
    x, y = x.astype(np.int64), y.astype(np.int64)
    while len(x) > len(y):
        x = x.reshape(-1, 2).sum(1)
    while len(y) > len(x):
        y = y.reshape(-1, 2).sum(1)
    return int(np.abs(x - y).sum())


def _set_rows(batches):
    for batch in batches:
        nodes = batch.column(0).to_numpy(zero_copy_only=False)
        part: list = []
        size = 0
        for i, s in sets_of(batch.column(1)):
            part.append((nodes[i], len(s), s.tobytes(), sketch(s).tobytes()))
            size += s.nbytes
            if size > CHUNK or i == len(nodes) - 1:
                cols = list(zip(*part, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], ["node", "n", "elements", "sketch"])
                part, size = [], 0


def _possible(batches):
    """a, b, sizes and sketches -> the pairs that may be linked."""
    for batch in batches:
        na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        x, y = batch.column(4), batch.column(5)
        keep = np.zeros(len(batch), bool)
        for i in range(len(batch)):
            if 100 * min(na[i], nb[i]) >= 80 * max(na[i], nb[i]):
                keep[i] = 9 * apart(np.frombuffer(x[i].as_buffer(), np.uint8), np.frombuffer(y[i].as_buffer(), np.uint8)) <= na[i] + nb[i]
        yield batch.filter(pa.array(keep)).select([0, 1])


def possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches do not rule out."""
    s1 = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    s2 = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    return pairs.join(s1, "b").join(s2, "a").select("a", "b", "na", "nb", "x", "y").mapInArrow(_possible, "a long, b long")


def _members(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    return long[np.minimum(np.searchsorted(long, short), len(long) - 1)] == short


def _verify(hot: np.ndarray, freq: np.ndarray, tokens: bool):
    """a, b, sets -> a, b, sizes of intersection and union, and the first tokens of the symmetric difference.

    The tokens stand in an order that is the same for all sets compared with one a: rare ones that b adds, those
    that b lacks, frequent ones that b adds. As many are given as any partner of b can need.
    """

    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            both, either, first = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), []
            for i in range(len(batch)):
                p, q = np.frombuffer(x[i].as_buffer(), _U), np.frombuffer(y[i].as_buffer(), _U)
                new = _members(q, p)
                both[i] = new.sum()
                either[i] = len(p) + len(q) - both[i]
                if tokens:
                    more, less = q[~new], p[~_members(p, q)]
                    often = _cost(more, hot, freq)
                    d = np.r_[more[often == 0], less, more[often > 0][np.argsort(often[often > 0], kind="stable")]]
                    n = len(d)
                    most = n - (4 * n + 8) // 9 + 1 if 100 * both[i] >= 80 * either[i] else (len(q) + len(q) * 5 // 4) // 9 + 1
                    first.append(d[:most].view(np.int64))
            out = [batch.column(0), batch.column(1), pa.array(both), pa.array(either)]
            yield pa.RecordBatch.from_arrays([*out, pa.array(first, pa.list_(pa.int64()))] if tokens else out, ["a", "b", "both", "either", "tokens"][: 4 + tokens])

    return run


def verified(pairs: DataFrame, sets: DataFrame, hot: np.ndarray = np.empty(0, _U), freq: np.ndarray = np.empty(0), tokens: bool = False) -> DataFrame:
    """pairs (a, b) with the sizes of intersection (both) and union (either)."""
    s1 = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    s2 = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    return pairs.join(s1, "b").join(s2, "a").select("a", "b", "x", "y").mapInArrow(_verify(hot, freq, tokens), "a long, b long, both long, either long" + ", tokens array<long>" * tokens)


LINKED = "100 * both >= 80 * either"


def components(links: DataFrame, spark: SparkSession) -> DataFrame:
    """links (a, b) -> node, comp: the smallest node reachable. Nodes without links are left out."""
    edges = kept(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), spark, "cc-edges")
    label = kept(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("comp")), spark, "cc-labels")
    while True:
        seen = edges.join(label.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        low = label.join(seen, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = label.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        new = kept(low.join(jump, "comp", "left").select("node", "was", F.least("comp", F.coalesce("root", "comp")).alias("comp")), spark, "cc-labels")
        label = new.select("node", "comp")
        if new.where("was <> comp").isEmpty():
            return label


def _joined(comp: DataFrame, links: DataFrame, spark: SparkSession) -> DataFrame:
    """comp (node, comp) after more links: only the components that these touch are looked at."""
    label = lambda side: F.coalesce(f"{side}_comp", side)
    of = lambda side: comp.select(F.col("node").alias(side), F.col("comp").alias(f"{side}_comp"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(label("a").alias("a"), label("b").alias("b")).where("a <> b").distinct()
    root = components(kept(between, spark, "join-between"), spark)
    moved = comp.join(root.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp", "left").select("node", F.coalesce("root", "comp").alias("comp"))
    return kept(moved.union(root.join(comp.select("node"), "node", "left_anti").select("node", "comp")), spark, "join-comps")


def node_of(text: Column, clashes: list[bytes] | None = None) -> Column:
    """64 bits of a text's digest, which stand for the text and all its copies. clashes: digests that need another name."""
    digest = F.md5(text.cast("binary"))
    name = F.xxhash64(digest)
    return F.when(digest.isin(clashes), F.xxhash64(digest, F.lit(len(clashes)))).otherwise(name) if clashes else name


def _clashes(ids: DataFrame) -> list[bytes]:
    """Digests (of node, low, high: the least and largest digest by name) that do not have a name of their own."""
    found = ids.where("low <> high").select(F.explode(F.array("low", "high"))).limit(MAX_CLASHES).collect()
    return sorted({r[0] for r in found})


def join(docs: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, copy_of: a row for each row of docs. copy_of: the smallest id of the same text."""
    spark = spark or docs.sparkSession
    with batches_of(spark, ROWS_AT_ONCE):
        ids, found, _ = _join(docs, spark)
    out = ids.join(found.drop("first").withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left")
    alone = F.col("k").isNull()
    return out.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("copy_of"))


def _probing(role: str = "role") -> Column:
    return F.pmod(role, F.lit(SHORT)).isin(BOTH, PROBE, OWN, ELEMENT)


def enough(shared: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of keys whose set shares as many of its own band's keys, or of those below, as a similar set would.

    Rows of elements, and of buckets that a set with too few segments probes, all stay (sure). degree: keys of the set; below:
    whether the key is of the band below.
    """
    sure = shared.where(F.col("role") > SHORT).select(F.col("key").alias("k")).distinct()
    rows = shared.where(F.col("role") != SIZE).join(sure, F.col("key") == F.col("k"), "left")
    below = F.min((F.pmod("role", F.lit(SHORT)) == PROBE).cast("int"))  # a band's keys are its own: no key is both
    rows = rows.groupBy("key", "node").agg(below.alias("below"), F.max((F.col("role") == ELEMENT) | F.col("k").isNotNull()).alias("sure"))
    return _pruned(rows.join(sizes.select("node", "q_own", "q_below"), "node"))


def _pruned(rows: DataFrame) -> DataFrame:
    by_node = W.partitionBy("node")
    rows = rows.withColumn("own", F.sum(1 - F.col("below")).over(by_node)).withColumn("other", F.sum("below").over(by_node)).withColumn("degree", F.col("own") + F.col("other"))
    return rows.where(F.col("sure") | F.when(F.col("below") == 1, F.col("other") >= F.col("q_below")).otherwise(F.col("own") >= F.col("q_own"))).drop("own", "other")


def _with_hubs(rows: DataFrame) -> DataFrame:
    """rows (key, node, degree and others) of keys with several nodes, with the key's hub.

    First that is the node of the highest degree; then, twice, the one that most keys have chosen: so few nodes are hubs of many
    keys, and a node meets few hubs.
    """
    votes = None
    for _ in range(3):
        of = rows if votes is None else rows.join(votes, F.col("node") == F.col("voted"), "left")
        rank = [F.coalesce("votes", F.lit(0)).alias("votes")] if votes is not None else []
        hubs = of.groupBy("key").agg(F.max(F.struct(*rank, "degree", "node"))["node"].alias("hub"), F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
        votes = hubs.groupBy(F.col("hub").alias("voted")).agg(F.count(F.lit(1)).alias("votes"))
    return rows.join(hubs.select(F.col("key").alias("k"), "hub"), F.col("key") == F.col("k")).drop("k")


def _with_comp(rows: DataFrame, comp: DataFrame) -> DataFrame:
    return rows.drop("comp").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def _open(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """rows (key, node and others) but hubs, of keys whose nodes are in several components; with comp."""
    rows = _with_comp(rows.where("node <> hub"), comp)
    several = rows.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 < c2").select(F.col("key").alias("k"))
    # of the keys that sets of other components have: as many as a similar one would share
    return _pruned(rows.join(several, F.col("key") == F.col("k"), "left_semi"))


def _join(docs: DataFrame, spark: SparkSession) -> tuple[DataFrame, DataFrame, list[bytes]]:
    """ids (doc_id, node), sets (node, rep, n, component_id, first: the node that stands for its component), and clashing digests."""
    own = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    clashes: list[bytes] = []
    while True:
        digest = F.md5(F.col("text").cast("binary"))
        of = own.where(worded).groupBy(node_of(F.col("text"), clashes).alias("node")).agg(F.min("doc_id").alias("rep"), F.min(digest).alias("low"), F.max(digest).alias("high"))
        of = kept(of, spark, "join-copies")
        if not (more := _clashes(of)):
            break
        clashes = sorted({*clashes, *more})
    of = of.select("node", "rep")
    node = node_of(F.col("text"), clashes)
    ids = own.select("doc_id", F.when(worded, node).alias("node"))

    # texts stay where they are read: a task skips copies that it has met, the rest meet in the keys
    texts = own.where(worded).select(node.alias("node"), "text")
    every = max(1, of.count() // SAMPLE)
    some = texts.where(F.pmod("node", F.lit(every)) == 0)
    hot, freq = _frequent(some.mapInArrow(_emit(np.empty(0, _U), np.empty(0)), _ROWS).where(F.col("role") != SIZE))
    hot_tokens = _frequent(some.where(F.pmod("node", F.lit(4 * every)) == 0).mapInArrow(_elements, "key long, node long"))
    rows = texts.mapInArrow(_emit(hot, freq, hot[freq >= max(SEEN, SAMPLE // HOT_SHARE)]), _ROWS)
    is_hot, role = F.col("role") >= HOT, F.pmod("role", F.lit(HOT)).cast("byte")
    # a key, or a frequent one with its salt, in one number, which sorts faster than two; the key comes from it again
    salted = lambda key: F.when(is_hot, F.col(key).bitwiseXOR(F.pmod("node", F.lit(SALTS)) * F.lit(SALT))).otherwise(F.col(key))
    rows = rows.select(salted("key").alias("place"), "node", "role")
    bucket = W.partitionBy("place")
    is_size, indexed = F.col("role") == SIZE, F.pmod("role", F.lit(SHORT)).isin(INDEXED, BOTH, ELEMENT).cast("int")
    # most keys have one node: what else is asked of a bucket is asked of the others alone
    keyed = rows.withColumn("low", F.min("node").over(bucket)).withColumn("high", F.max("node").over(bucket)).where(is_size | is_hot | (F.col("low") < F.col("high")))
    keyed = keyed.withColumn("p", F.max(_probing().cast("int")).over(bucket)).withColumn("i", F.max(indexed).over(bucket)).where(is_size | is_hot | ((F.col("p") == 1) & (F.col("i") == 1)))
    shared = kept(keyed.groupBy("place", "node", "role").agg(F.max("low")).select(salted("place").alias("key"), "node", role.alias("role")), spark, "join-keys")  # rows of a place are together: no shuffle
    packed = lambda shift, bits: F.shiftright("key", shift).bitwiseAND((1 << bits) - 1)
    sizes = kept(shared.where(F.col("role") == SIZE).groupBy("node").agg(F.max("key").alias("key")).select("node", packed(0, 32).alias("n"), packed(32, 16).alias("q_own"), packed(48, 15).alias("q_below")), spark, "join-sizes")

    # who shares too few keys to have a similar set goes, then buckets that are left with one member; the rest get their hub
    counted = kept(enough(shared, sizes), spark, "join-enough")
    stars = kept(_with_hubs(counted), spark, "join-stars")

    wanted = kept(stars.select("node").distinct().join(of, "node"), spark, "join-wanted")
    if wanted.count() <= MAX_BROADCAST:
        wanted = F.broadcast(wanted)
    w = wanted.select(F.col("node").alias("w"), "rep")
    sets = own.where(worded).select("doc_id", node.alias("node"), "text").join(w, (F.col("node") == F.col("w")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi")
    sets = kept(sets.select("node", "text").mapInArrow(_set_rows, "node long, n long, elements binary, sketch binary").dropDuplicates(["node"]), spark, "join-sets")

    # each bucket's members are compared with its hub, then what is left of the bucket with a hub among that, and so on
    left, comp = stars, None
    for turn in range(1 + PEELS):
        pairs = left.where("node <> hub")
        if comp is not None:
            pairs = pairs.join(comp.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp")), "hub", "left").where(F.col("comp") != F.coalesce("hub_comp", "hub"))
        pairs = possible(pairs.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), sets)
        new = kept(verified(pairs, sets).where(LINKED).select("a", "b"), spark, "join-links")
        if turn and new.isEmpty():
            break
        comp = components(new, spark) if comp is None else _joined(comp, new, spark)
        if turn == PEELS:  # none gets another hub, so open buckets are not looked for again
            left = _with_comp(left, comp)
            break
        # kept once: hubs read their rows several times, and would make this join for each
        left = kept(_open(left, comp), spark, "join-rest")
        left = kept(_with_hubs(left.drop("hub")), spark, "join-left")

    # pairs of different components that still share a bucket: by what sets them apart from the bucket's first hub
    hubs = stars.select("key", "node", F.col("hub").alias("hub1"))
    apart_ = left.where("node <> hub").select("key", "node", "comp").join(hubs, ["key", "node"])
    apart_ = kept(apart_.select(F.col("hub1").alias("hub"), "node", "comp").distinct(), spark, "join-apart")
    told = kept(verified(apart_.select(F.col("hub").alias("a"), F.col("node").alias("b")), sets, *hot_tokens, tokens=True), spark, "join-told")
    told = told.select(F.col("a").alias("hub"), F.col("b").alias("node"), (F.col("either") - F.col("both")).alias("d"), "tokens")
    mains = apart_.groupBy("hub", "comp").count().groupBy("hub").agg(F.max(F.struct("count", "comp"))["comp"].alias("main"))
    told = told.join(apart_, ["hub", "node"]).join(mains, "hub").join(sizes.select("node", "n"), "node")
    told = kept(told.select("hub", "node", "comp", (F.col("comp") == F.col("main")).alias("is_main"), "n", "d", F.posexplode("tokens").alias("at", "token")), spark, "join-tokens")
    x, y = told.where("NOT is_main").alias("x"), told.alias("y")
    # elements that the two differences must have in common
    least = F.floor((F.col("x.d") + F.col("y.d") - F.floor((F.col("x.n") + F.col("y.n")) / 9) + 1) / 2)
    alike = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.token") == F.col("y.token")) & (F.col("y.is_main") | (F.col("x.node") < F.col("y.node"))) & (F.col("x.comp") != F.col("y.comp"))
    alike = alike & (100 * F.least("x.n", "y.n") >= 80 * F.greatest("x.n", "y.n")) & (F.col("x.at") <= F.col("x.d") - least) & (F.col("y.at") <= F.col("y.d") - least)
    rest = x.join(y, alike).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    more = kept(verified(possible(rest, sets), sets).where(LINKED).select("a", "b"), spark, "join-more")
    if not more.isEmpty():
        comp = _joined(comp, more, spark)

    groups = of.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # a component is named by its smallest id, and stands for itself by the set of that id
    first = groups.groupBy("comp").agg(F.min("rep").alias("component_id"), F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node"))["node"].alias("first"))
    found = kept(groups.join(first, "comp").join(sizes, "node").select("node", "rep", "n", "component_id", "first"), spark, "join-found")
    return ids, found, clashes


def one_of_each(docs: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """docs with one row of each component: one with the text and the id of its smallest doc_id (null counts as largest).

    Rows without words all stay. Of rows of one id with different texts each is judged by its text.
    """
    spark = spark or docs.sparkSession
    cols = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    doc_id, text = F.col(f"c{cols.index('doc_id')}"), F.col(f"c{cols.index('text')}")
    with batches_of(spark, ROWS_AT_ONCE):
        ids, found, clashes = _join(rows.select(doc_id.alias("doc_id"), text.alias("text")), spark)
    stay = found.where("node = first").select(F.col("node").alias("k"), "rep")
    # exact repetitions of the row that stays, if any, are aggregated; all others stay where they are read
    times = ids.join(stay, (F.col("node") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep"))).groupBy("k", "rep").agg(F.count(F.lit(1)).alias("times"))
    stay = kept(times, spark, "join-stay")
    if stay.count() <= MAX_BROADCAST:
        stay = F.broadcast(stay)
    blank = ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    node = F.when(~blank, node_of(text, clashes))
    marked = rows.withColumn("__node", node).join(stay, (F.col("__node") == F.col("k")) & doc_id.eqNullSafe(F.col("rep")), "left")
    out = marked.where(blank | (F.col("times") == 1)).select(*rows.columns)
    if not stay.where("times > 1").isEmpty():
        again = marked.where("times > 1").dropDuplicates(["k", "rep"]).select(*rows.columns)
        out = out.union(again)
    return out.toDF(*cols)


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM g),
e AS (SELECT doc_id, unnest(s) AS x FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * common >= 80 * (na.n + nb.n - common)),
l2 AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l2.b FROM r JOIN l2 ON r.b = l2.a)
SELECT doc_id, n AS n_shingles, c AS component_id FROM n JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) ON a = doc_id"""
