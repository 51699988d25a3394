"""Token ids in a bit-plane shuffled file format.

A store is a folder with two tables. ``chunks`` holds binary chunks, each with whole documents in ascending
doc_id order; ``index`` has a row for each chunk: its place, first and last doc_id, number of documents and ids, and the
number of ids before it in the whole store. Shards are ranges of doc_id, written by independent tasks through Spark's
commit protocol, so lost executors leave no half-written shard.

A chunk: a header; lengths and ids of its documents; then blocks of BLOCK ids (the last may be shorter). Each
block is transposed: with ``planes="byte"`` all first bytes, all second bytes and so on, with ``"bit"`` all lowest bits, all
next bits and so on. Every plane is compressed by zstandard by itself; planes of zeros are not stored.
Sizes of all planes stand before the blocks, so any block can be read without the ones before it.

Encoding: the tokenizer's own pre-tokenizer is applied as a regular expression and the ids of each piece are remembered,
so that the tokenizers library meets a piece once, not each time. Texts for which the two could differ (special
tokens' strings, characters outside well-known blocks) are encoded whole by the library.

Defined results: null and empty texts have the end id alone; a null doc_id stands before all others; rows of one doc_id
stand in the order of their texts' hashes; an empty table gives an empty store.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm._shared import pick
from folioscope.session import shared_dir

END, BLOCK, CHUNK_IDS, LEVEL = 2, 1 << 16, 1 << 20, 1
MAGIC = b"FBP1"
NULL_ID = -(1 << 63)
#: Pieces whose ids a worker remembers.
MEMO = 1_200_000
#: Texts that are encoded together.
TOGETHER = 64
_HEAD = struct.Struct("<4sBBIQI")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- planes -------------------------------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of a block of ids, lowest first; b"" for a plane of zeros."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        cols = [raw[:, k] for k in range(4)]
    else:
        cols = [np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1) for k in range(32)]
    return [c.tobytes() if c.any() else b"" for c in cols]


def from_planes(parts: list[bytes], n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        out = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(parts):
            if p:
                out[:, k] = np.frombuffer(p, np.uint8)
        return out.reshape(-1).view("<u4")
    out = np.zeros(n, np.uint32)
    for k, p in enumerate(parts):
        if p:
            out |= np.unpackbits(np.frombuffer(p, np.uint8), count=n).astype(np.uint32) << np.uint32(k)
    return out


# ---- chunks -------------------------------------------------------------------------------------------------------


def pack_chunk(doc_ids: list[int | None], ids: list[np.ndarray], planes: str = "byte", block: int = BLOCK, level: int = LEVEL) -> bytes:
    """One chunk of whole documents."""
    import zstandard

    z = zstandard.ZstdCompressor(level=level)
    flat = np.concatenate(ids).astype("<u4") if ids else np.empty(0, "<u4")
    names = np.array([NULL_ID if d is None else d for d in doc_ids], "<i8")
    heads = z.compress(names.tobytes() + np.array([len(x) for x in ids], "<u8").tobytes())
    sizes, body = [], []
    for at in range(0, len(flat), block):
        for p in to_planes(flat[at : at + block], planes):
            c = z.compress(p) if p else b""
            sizes.append(len(c))
            body.append(c)
    table = np.array(sizes, "<u4").tobytes()
    head = _HEAD.pack(MAGIC, 1, planes == "bit", len(doc_ids), len(flat), block)
    return b"".join([head, struct.pack("<II", len(heads), len(table)), heads, table, *body])


def chunk_documents(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """doc_ids and lengths of a chunk's documents."""
    import zstandard

    n = _HEAD.unpack_from(blob)[3]
    size = struct.unpack_from("<I", blob, _HEAD.size)[0]
    raw = zstandard.ZstdDecompressor().decompress(blob[_HEAD.size + 8 : _HEAD.size + 8 + size])
    return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, "<u8", n, 8 * n).astype(np.int64)


def chunk_blocks(blob: bytes, first: int = 0, last: int | None = None):
    """Ids of the blocks first..last-1 (all by default), one by one."""
    import zstandard

    magic, version, bits, _, total, block = _HEAD.unpack_from(blob)
    if magic != MAGIC or version != 1:
        raise ValueError("not a chunk of this format")
    planes, k = ("bit", 32) if bits else ("byte", 4)
    heads, table = struct.unpack_from("<II", blob, _HEAD.size)
    at = _HEAD.size + 8 + heads
    sizes = np.frombuffer(blob, "<u4", table // 4, at).astype(np.int64)
    starts = at + table + np.r_[0, np.cumsum(sizes)]
    z = zstandard.ZstdDecompressor()
    count = -(-total // block) if total else 0
    for b in range(first, count if last is None else min(last, count)):
        parts = [z.decompress(blob[starts[i] : starts[i + 1]]) if sizes[i] else b"" for i in range(b * k, b * k + k)]
        yield from_planes(parts, min(block, total - b * block), planes)


# ---- encoding -----------------------------------------------------------------------------------------------------

#: Letters for which the expressions below agree with the tokenizer.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-яぁ-ゖァ-ヺ一-龥가-힣"
_KNOWN = re.compile(f"[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf×÷‐-‧{_LETTERS}]")
_PIECES = re.compile(rf" ?[{_LETTERS}]++| ?[0-9]++|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s0-9{_LETTERS}]++|\s+(?!\S)|\s+")


class _Memo(dict):
    """piece -> its ids as bytes; a piece that is not there gives itself and is noted as new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> str:
        self.new.append(piece)
        return piece


class Encoder:
    """text -> little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.memo = _Memo()

    def __call__(self, text: str | None) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; pieces that are new to any of them are learned together."""
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        out: list = []
        for text in texts:
            if not text:
                out.append(b"")
            elif _KNOWN.search(text) or any(s in text for s in self.special):
                out.append(np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                met = len(memo.new)
                parts = [memo[p] for p in _PIECES.findall(text)]
                out.append(b"".join(parts) if len(memo.new) == met else parts)
        if memo.new:
            new, memo.new = list(dict.fromkeys(memo.new)), []
            self._learn(new)
        return [x if type(x) is bytes else b"".join([memo[p] if type(p) is str else p for p in x]) for x in out]

    def _learn(self, new: list[str]) -> None:
        # words that begin with a space fall apart again where they were joined, so one call encodes them all
        words = [p for p in new if p[0] == " " and p[1:].isalpha()]
        if words:
            e = self.library.encode("".join(words), add_special_tokens=False)
            ids, of = np.array(e.ids, "<u4"), np.array(e.word_ids)
            cuts = np.flatnonzero(np.diff(of)) + 1
            if len(cuts) == len(words) - 1:
                raw, ends = ids.tobytes(), [*(cuts * 4).tolist(), len(ids) * 4]
                at = 0
                for p, end in zip(words, ends, strict=True):
                    self.memo[p] = raw[at:end]
                    at = end
                new = [p for p in new if p not in self.memo]
        for p, e in zip(new, self.library.encode_batch(new, add_special_tokens=False), strict=True):
            self.memo[p] = array("I", e.ids).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process, so later tasks find what earlier ones met."""
    return Encoder(path)


_CHUNKS = "shard int, chunk int, first_doc long, last_doc long, n_docs int, n_ids long, data binary"


def _pack(path: str, end: int, planes: str, block: int, chunk_ids: int, level: int):
    def run(batches):
        encode, shard, chunk = encoder(path), TaskContext.get().partitionId(), 0
        docs: list = []
        ids: list = []
        total = 0

        def out():
            blob = pack_chunk(docs, ids, planes, block, level)
            row = [shard, chunk, docs[0], docs[-1], len(docs), total, blob]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], ["shard", "chunk", "first_doc", "last_doc", "n_docs", "n_ids", "data"])

        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), TOGETHER):
                part = batch.slice(at, TOGETHER)
                for d, raw in zip(part.column(0).to_pylist(), encode.many(part.column(1).to_pylist()), strict=True):
                    own = np.frombuffer(raw + tail, "<u4")
                    docs.append(d)
                    ids.append(own)
                    total += len(own)
                    if total >= chunk_ids:
                        yield out()
                        docs, ids, total, chunk = [], [], 0, chunk + 1
        if docs:
            yield out()

    return run


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, planes: str = "byte", block: int = BLOCK, chunk_ids: int = CHUNK_IDS, level: int = LEVEL, shards: int | None = None) -> None:
    """Encodes docs (doc_id, text) and writes them as a store to path."""
    spark = docs.sparkSession
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    rows.mapInArrow(_pack(tokenizer or tokenizer_path(), end, planes, block, chunk_ids, level), _CHUNKS).write.mode("overwrite").parquet(f"{path}/chunks")
    index = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks").drop("data")
    # sums of shards, of which there are as many as write tasks; then of chunks within a shard
    shard_sums = index.groupBy("shard").agg(F.sum("n_ids").alias("all_ids"))
    before = F.sum("all_ids").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("all_ids")
    shard_sums = shard_sums.select(F.col("shard").alias("s"), before.alias("before"))
    within = F.sum("n_ids").over(W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids")
    index = index.withColumn("within", within).join(shard_sums, F.col("shard") == F.col("s")).withColumn("start", F.col("before") + F.col("within"))
    index.drop("s", "before", "within").write.mode("overwrite").parquet(f"{path}/index")


def _digest(batches):
    """Chunks -> a row for each document: its place in the chunk, length and crc32."""
    for batch in batches:
        for shard, chunk, data in zip(*(batch.column(i) for i in range(3)), strict=True):
            blob = data.as_py()
            names, lens = chunk_documents(blob)
            crcs, stream, have = [], chunk_blocks(blob), np.empty(0, "<u4")
            for n in lens:
                crc = 0
                while n:
                    if not len(have):
                        have = next(stream)
                    part, have = have[:n], have[n:]
                    crc, n = zlib.crc32(part.tobytes(), crc), n - len(part)
                crcs.append(crc)
            k = len(lens)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, shard.as_py(), np.int32)), pa.array(np.full(k, chunk.as_py(), np.int32)), pa.array(names, mask=names == NULL_ID), pa.array(np.cumsum(lens) - lens), pa.array(lens), pa.array(np.array(crcs, np.int64))], ["shard", "chunk", "doc_id", "at", "n_tokens", "ids_crc32"])


def digest_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the store's files."""
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks").select("shard", "chunk", "data")
    rows = chunks.mapInArrow(_digest, "shard int, chunk int, doc_id long, at long, n_tokens long, ids_crc32 long")
    index = spark.read.schema("shard int, chunk int, start long").parquet(f"{path}/index")
    return rows.join(index, ["shard", "chunk"]).select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _unpack(batches):
    for batch in batches:
        for data in batch.column(0):
            blob = data.as_py()
            names, lens = chunk_documents(blob)
            flat = np.concatenate(list(chunk_blocks(blob)) or [np.empty(0, "<u4")]).astype(np.int64)
            offs = pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(names, mask=names == NULL_ID), pa.ListArray.from_arrays(offs, pa.array(flat))], ["doc_id", "ids"])


def read_store(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """doc_id, ids of the store's documents; of those from low to high only (chunks without them are skipped)."""
    chunks = spark.read.schema(_CHUNKS).parquet(f"{path}/chunks")
    if low is not None:
        chunks = chunks.where(F.col("last_doc") >= low)
    if high is not None:
        chunks = chunks.where(F.col("first_doc") <= high)
    rows = chunks.select("data").mapInArrow(_unpack, "doc_id long, ids array<long>")
    keep = F.lit(True) if low is None else F.col("doc_id") >= low
    return rows.where(keep & (F.lit(True) if high is None else F.col("doc_id") <= high))


def scratch_path(spark: SparkSession) -> str:
    import uuid

    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
