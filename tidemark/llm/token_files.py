"""Token-id files with Elias-Fano document boundaries.

Documents are ordered by id, encoded, and written as shards.  A shard is one
binary file: a header, the concatenated ids of its documents (16 or 32 bits
each, by the vocabulary), and two Elias-Fano sequences, the boundaries of the
documents in the id array and the document ids.  Elias-Fano keeps a sorted
sequence of n numbers below u in about 2 + log2(u / n) bits each: the low bits
packed, the high bits as a unary bit string whose i-th one stands at
``high + i``; a 32-bit sample for every 256th one lets ``select(i)`` read a
few bytes.  No table of 64-bit offsets exists.

Texts are range-partitioned by (id, text hash, row number), so one id with
very many rows spreads over partitions, and sorted there by Spark, which
spills; a task encodes its sorted stream and cuts shards of bounded size.
The files go through Spark's text sink, one record a file: any Hadoop file
system, exactly one copy of a shard under retries and lost executors.  The
sink ends a record with a line feed, the format's last byte.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import made_once
from .token_counts import _LATIN_FIND, _LATIN_ONLY, byte_alphabet

MAGIC = b"TIDIDS01"
#: Magic, shard number, smallest id, rows, rows of null id, ids, bits of the two unary strings, bytes an id, low bits
#: of the two sequences, checksum of what follows.
HEADER = "<8sqqIIIIIBBBxI"
HEADER_BYTES = struct.calcsize(HEADER)
#: Ones between two samples of a unary string.
SAMPLE = 256
#: Ids of a shard, but for a longer last document.
SHARD_IDS = 4_000_000
#: Text bytes that one task sorts and encodes; it spills, so this bounds time rather than memory.
PARTITION_BYTES = 1 << 30
#: Pre-tokens whose ids a Python worker remembers over its tasks; when full, it starts anew.
MEMO = 400_000


class EliasFano:
    """A non-decreasing sequence of unsigned numbers with ``select``."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits = n, low_bits
        self._low = np.frombuffer(low, np.uint8)
        self._high = np.frombuffer(high, np.uint8)
        self._samples = samples

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, np.uint64)
        n = len(v)
        if not n:
            return cls(0, 0, b"", b"", np.zeros(0, "<u4"))
        bits = max(0, ((int(v[-1]) + 1) // n).bit_length() - 1)
        at = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1, np.uint8)
        high[at] = 1
        low = b""
        if bits:
            shifts = np.arange(bits, dtype=np.uint64)
            low = b"".join(np.packbits((v[i:i + 65536, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(),
                                       bitorder="little").tobytes() for i in range(0, n, 65536))
        return cls(n, bits, low, np.packbits(high, bitorder="little").tobytes(), at[::SAMPLE].astype("<u4"))

    @staticmethod
    def sizes(n: int, low_bits: int, high_bits: int) -> tuple[int, int, int]:
        """Bytes of the low part, the unary string and the samples."""
        return (n * low_bits + 7) // 8, (high_bits + 7) // 8, 4 * ((n + SAMPLE - 1) // SAMPLE)

    @classmethod
    def read(cls, data: memoryview, n: int, low_bits: int, high_bits: int) -> "EliasFano":
        a, b, c = cls.sizes(n, low_bits, high_bits)
        return cls(n, low_bits, data[:a], data[a:a + b], np.frombuffer(data[a + b:a + b + c], "<u4"))

    @property
    def high_bits(self) -> int:
        if not self.n:
            return 0
        last = np.unpackbits(self._high[-1:], bitorder="little")
        return 8 * (len(self._high) - 1) + int(np.flatnonzero(last)[-1]) + 1

    def tobytes(self) -> bytes:
        return self._low.tobytes() + self._high.tobytes() + self._samples.tobytes()

    def _lows(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, np.uint64)
        lo, hi = first * self.low_bits, last * self.low_bits
        bits = np.unpackbits(self._low[lo // 8:(hi + 7) // 8], bitorder="little")[lo % 8:][:hi - lo]
        weight = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th number (from 0): the samples name a byte near its one, and a few bytes are read on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        start, left = int(self._samples[i // SAMPLE]), i % SAMPLE
        byte, skip = start // 8, start % 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self._high[byte:byte + 64], bitorder="little")[skip:])
            if left < len(ones):
                at = 8 * byte + skip + int(ones[left])
                break
            left -= len(ones)
            byte, skip = byte + 64, 0
        return ((at - i) << self.low_bits) | int(self._lows(i, i + 1)[0])

    def values(self) -> np.ndarray:
        """All numbers, in pieces of bounded scratch space."""
        if not self.n:
            return np.zeros(0, np.uint64)
        at = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[:self.n]
        high = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        low = [self._lows(i, min(self.n, i + 65536)) for i in range(0, self.n, 65536)]
        return high | np.concatenate(low)


def pack_shard(shard: int, doc_ids: list, lengths: list[int], ids: bytes, width: int) -> bytes:
    """A shard's bytes, less the closing line feed.  ``doc_ids`` ascend, nulls first; an id takes ``width`` bytes."""
    nulls = sum(1 for k in doc_ids if k is None)
    known = np.array(doc_ids[nulls:], np.int64)
    least = int(known[0]) if len(known) else 0
    ends = EliasFano.encode(np.concatenate(([0], np.cumsum(np.array(lengths, np.int64)))))
    names = EliasFano.encode(known.view(np.uint64) - np.array([least], np.int64).view(np.uint64))
    body = ids + ends.tobytes() + names.tobytes()
    return struct.pack(HEADER, MAGIC, shard, least, len(doc_ids), nulls, len(ids) // width, ends.high_bits, names.high_bits,
                       width, ends.low_bits, names.low_bits, zlib.crc32(body)) + body


class Shard:
    """One shard read back: ``doc_id(i)``, ``offset(i)`` and ``ids(i)`` by select, or whole arrays."""

    def __init__(self, data: bytes):
        head = struct.unpack_from(HEADER, data)
        (magic, self.number, self._least, self.n, self.nulls, self.n_ids, ends, names, width, low_a, low_b, crc) = head
        body = memoryview(data)[HEADER_BYTES:len(data) - 1]
        if magic != MAGIC or data[-1:] != b"\n" or zlib.crc32(body) != crc:
            raise ValueError("not a whole token-id shard")
        self.tokens = np.frombuffer(body[:self.n_ids * width], f"<u{width}")
        body = body[self.n_ids * width:]
        self._ends = EliasFano.read(body, self.n + 1, low_a, ends)
        body = body[sum(EliasFano.sizes(self.n + 1, low_a, ends)):]
        self._names = EliasFano.read(body, self.n - self.nulls, low_b, names)

    def offset(self, i: int) -> int:
        return self._ends.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self._names.select(i - self.nulls) + self._least

    def ids(self, i: int) -> np.ndarray:
        return self.tokens[self.offset(i):self.offset(i + 1)]

    def offsets(self) -> np.ndarray:
        return self._ends.values().astype(np.int64)

    def doc_ids(self) -> list:
        least = np.array([self._least], np.int64).view(np.uint64)
        return [None] * self.nulls + (self._names.values() + least).view(np.int64).tolist()


class _Words(dict):
    """Pre-token -> packed ids, encoded by the library's model when first met."""

    def __init__(self, model, width: str):
        super().__init__()
        self._tokenize, self._width = model.tokenize, width
        self._letters = dict(enumerate(byte_alphabet()))

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        tokens = self._tokenize(word.encode("utf-8").decode("latin-1").translate(self._letters))
        ids = self[word] = np.array([t.id for t in tokens], self._width).tobytes()
        return ids


class Encoder:
    """Packed ids of whole texts as the library gives them: no added begin or end tokens, truncation or padding.

    Pre-tokens of a byte-level vocabulary do not depend on one another, and
    texts repeat them.  Texts of characters below U+0250, whose classes are
    listed, are cut here, and each pre-token is encoded by the library's model
    once; the library encodes all other texts, and other kinds of files, whole.
    ``special``: strings of added tokens stand for their token, as by default;
    otherwise they are ordinary text.
    """

    def __init__(self, spec: bytes, width: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.width = width
        self.tokenizer = Tokenizer.from_buffer(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = not special
        self.words = None
        given = json.loads(spec)
        pre, model = given.get("pre_tokenizer") or {}, given["model"]
        if (model["type"] == "BPE" and not given.get("normalizer") and not model.get("dropout")
                and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)):
            self.tokenizer.model._resize_cache(1)        # the words below are its only cache
            self.words = _Words(self.tokenizer.model, width)
            self.added = [t["content"] for t in given.get("added_tokens") or []] if special else []

    def encode(self, text: str) -> bytes:
        if self.words is None or not _LATIN_ONLY(text) or any(s in text for s in self.added):
            return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.width).tobytes()
        return b"".join(map(self.words.__getitem__, _LATIN_FIND(text)))


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 0, id_col: str = "doc_id",
                      text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text and write the shards to the new folder ``path``.

    Documents stand in ascending id order, null ids first, rows of equal id by
    their text's hash; repeated rows are written as often as they came.  Each
    document ends with ``end_id``; null and empty texts hold nothing else.  Ids
    must be of an integer type.  Extra columns are ignored; an empty table
    writes no shard.
    """
    from tokenizers import Tokenizer
    with open(tokenizer_file, "rb") as f:
        spec = f.read()                                         # bounded by the vocabulary file
    top = max(Tokenizer.from_buffer(spec).get_vocab(with_added_tokens=True).values(), default=0)
    width = "<u2" if max(top, end_id) < 1 << 16 else "<u4"
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError("document ids must be of an integer type")
    spark = docs.sparkSession
    encoder_of = made_once(spark, spec, lambda s: Encoder(s, width))      # with the words it has met
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("body"))
    size = rows.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    order = ["id", "h", "row"]
    rows = (rows.withColumns({"h": F.xxhash64("body"), "row": F.monotonically_increasing_id()})
            .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, piece = encoder_of(), TaskContext.get().partitionId() << 32
        size, end = np.dtype(width).itemsize, np.array([end_id], width).tobytes()
        names, lengths, held, total = [], [], [], 0

        def shard() -> pa.RecordBatch:
            data = pack_shard(piece, names, lengths, b"".join(held), size)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["value"])

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoder.encode(text) + end
                    n = len(ids) // size
                    if total and total + n > shard_ids:
                        yield shard()
                        names, lengths, held, total, piece = [], [], [], 0, piece + 1
                    names.append(name)
                    lengths.append(n)
                    held.append(ids)
                    total += n
        if total:
            yield shard()

    # The cast keeps the bytes as they are; the sink writes them and a line feed.
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("maxRecordsPerFile", 1).text(path))


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0")


def shard_index(spark: SparkSession, path: str) -> DataFrame:
    """``(number, base)`` of every shard: ids of all shards before it, from the headers alone."""

    def run(batches):
        for b in batches:
            heads = [struct.unpack(HEADER, h) for h in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([h[1] for h in heads], pa.int64()),
                                              pa.array([h[5] for h in heads], pa.int64())], names=["number", "n"])

    heads = _shards(spark, path).select(F.substring("content", 1, HEADER_BYTES).alias("h"))
    heads = heads.mapInArrow(run, "number long, n long").withColumn("part", F.shiftright("number", 32))
    # Two levels: shards of a partition, and one row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = heads.groupBy("part").agg(F.sum("n").alias("all")).select(
        F.col("part").alias("p"), F.coalesce(F.sum("all").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (heads.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0)))
            .join(parts, F.col("part") == F.col("p")).select("number", (F.col("first") + F.col("own")).alias("base")))


def _read(spark: SparkSession, path: str, schema: str, columns: Callable[[Shard, np.ndarray], list]) -> DataFrame:
    """Rows ``(number, doc_id, offset, ...)`` of every shard, in batches of bounded size."""
    names = spark.createDataFrame([], schema).columns

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard(b.column(0)[i].as_py())
                at, who = shard.offsets(), shard.doc_ids()
                for lo in range(0, shard.n, 4096):
                    hi = min(shard.n, lo + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(hi - lo, shard.number)), pa.array(who[lo:hi], pa.int64()), pa.array(at[lo:hi]),
                         *columns(shard, at[lo:hi + 1])], names=names)

    return _shards(spark, path).select("content").mapInArrow(run, schema)


def _placed(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    index = shard_index(spark, path).withColumnRenamed("number", "shard")
    return rows.join(index, F.col("number") == F.col("shard")).withColumn("start", F.col("base") + F.col("offset"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every document of the files; ``start``: ids of all documents before it."""

    def columns(shard, at):
        values = pa.array(shard.tokens[at[0]:at[-1]].astype(np.int64))
        return [pa.ListArray.from_arrays(pa.array((at - at[0]).astype(np.int32)), values)]

    rows = _read(spark, path, "number long, doc_id long, offset long, ids array<long>", columns)
    return _placed(rows, spark, path).select("doc_id", "start", "ids")


def token_file_report(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, worked out from the files alone.

    ``n_tokens`` counts the end id; ``ids_crc32`` is the unsigned crc32 of the
    document's ids as little-endian unsigned 32-bit integers.
    """

    def columns(shard, at):
        data = memoryview(shard.tokens[at[0]:at[-1]].astype("<u4").tobytes())
        cut = (4 * (at - at[0])).tolist()
        return [pa.array(np.diff(at)), pa.array([zlib.crc32(data[a:b]) for a, b in zip(cut, cut[1:])], pa.int64())]

    rows = _read(spark, path, "number long, doc_id long, offset long, n_tokens long, ids_crc32 long", columns)
    return _placed(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
