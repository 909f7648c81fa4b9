"""Substring deduplication by content-defined chunking with a gear rolling hash.

The gear hash of a place depends on the last ``WINDOW`` bytes only; places
where its high bits are zero are chunk borders, so an insertion moves the
borders around it and no others.  Chunks are looked up by a 128-bit digest:
all but the first occurrence of a digest are repeats, and runs of adjacent
repeats with enough words are repeated passages.

* A border within ``MIN_BYTES`` of another candidate is passed over (a local
  rule too, so equal passages are cut alike whatever stands before them);
  ``MAX_BYTES`` cuts a stretch without borders.
* The digest counts are pre-aggregated per task before they are shuffled; the
  occurrences meet only the digests that occur more than once.  Those are
  written first, so both sides of that join are plain shuffles, whose skewed
  partitions (a digest in most texts) Spark splits.  A digest's occurrences are
  never gathered.
* Words are parted by ASCII white space; for scripts without blanks (Chinese,
  Japanese, Thai) a run counts by its length in bytes too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import checkpointed

#: Bytes that the gear hash of a place depends on.
WINDOW = 16
#: One place in 2**BORDER_BITS is a border.
BORDER_BITS = 4
MIN_BYTES = 12
MAX_BYTES = 1024
#: Words that a run of repeated chunks has at least, or else bytes.
MIN_WORDS = 15
LONG_RUN = 300


def gear_table(seed: int = 7) -> np.ndarray:
    """A fixed random 16-bit number for every byte value."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed) >> 16 for b in range(256)], np.uint16)


_GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash h = 2 h + gear[byte] (mod 2**16) behind every byte, by doubling windows."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        # The hash over 2w bytes from those over w bytes: h(i) + h(i - w) << w.
        h[width:] = h[width:] + (h[:-width] << np.uint16(width)) if len(h) > width else h[width:]
        width *= 2
    return h


def borders(raw: bytes) -> np.ndarray:
    """Ends of the chunks of a text (UTF-8), the last one included; no character is cut."""
    n = len(raw)
    if n == 0:
        return np.empty(0, np.int64)
    data = np.frombuffer(raw, np.uint8)
    h = gear_hashes(data)
    at = np.flatnonzero((h >> np.uint16(16 - BORDER_BITS)) == 0) + 1
    # Full windows only, and only between characters.
    at = at[(at >= WINDOW) & (at < n)]
    at = at[(data[at] & 0xC0) != 0x80]
    if len(at):
        at = at[np.concatenate(([True], np.diff(at) > MIN_BYTES))]
    ends = np.append(at, n)
    gaps = np.diff(ends, prepend=0)
    if gaps.max() <= MAX_BYTES:
        return ends
    out = []
    for start, end in zip((ends - gaps).tolist(), ends.tolist()):
        while end - start > MAX_BYTES:
            start += MAX_BYTES
            while data[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        out.append(end)
    return np.array(out)


_WORD_START = re.compile(rb"(?<![^\x20\t-\r])[^\x20\t-\r]")


def chunk_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk: ``(id, h, d1, d2, packed)``.

    ``h``, Spark's ``xxhash64`` of the text, tells texts of one id apart; ``d1, d2`` are the digest.  ``packed``
    holds the start (UTF-8 bytes), 11 bits of size, 10 bits of words that
    begin in the chunk, and a bit for a digest's first occurrence in its text.
    """
    kind = docs.schema[id_col].dataType
    schema = f"id {kind.simpleString()}, h long, d1 long, d2 long, packed long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                cols, ids, total = [[] for _ in range(4)], [], 0
                while lo < b.num_rows and total < 4_000_000:
                    raw = (b.column(1)[lo].as_py() or "").encode("utf-8", "surrogatepass")
                    ends = borders(raw)
                    if len(ends):
                        starts = np.concatenate(([0], ends[:-1]))
                        digest = [hashlib.blake2b(raw[s:e], digest_size=16).digest()
                                  for s, e in zip(starts.tolist(), ends.tolist())]
                        first = dict(zip(reversed(digest), reversed(range(len(digest)))))
                        fresh = np.array([first[x] == i for i, x in enumerate(digest)], np.int64)
                        begins = np.array([m.start() for m in _WORD_START.finditer(raw)], np.int64)
                        words = np.diff(np.searchsorted(begins, np.append(starts, len(raw))))
                        d = np.frombuffer(b"".join(digest), "<i8").reshape(-1, 2)
                        h = np.full(len(ends), np.uint64(xxhash.xxh64_intdigest(raw, 42))).view(np.int64)
                        for c, x in zip(cols, (h, d[:, 0], d[:, 1],
                                               starts << 22 | (ends - starts) << 11 | words << 1 | fresh)):
                            c.append(x)
                        ids.append((lo, len(ends)))
                    total += len(raw)
                    lo += 1
                if ids:
                    who = np.repeat([i for i, _ in ids], [n for _, n in ids])
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(who))] + [pa.array(np.concatenate(c)) for c in cols],
                        names=["id", "h", "d1", "d2", "packed"])

    return docs.select(F.col(f"`{id_col}`").alias("id"),
                       F.col(f"`{text_col}`").cast("string").alias("body")).mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                      text_col: str = "text", long_run: int = LONG_RUN) -> DataFrame:
    """Repeated passages, one row each: ``(doc_id, byte_start, byte_end, n_words, n_chunks, first_doc_id)``.

    A chunk is a repeat unless it is the first occurrence of its digest: the
    first in the document with the smallest id (rows that share an id count as
    one document; null ids come last).  A passage is a run of adjacent
    repeats with ``min_words`` words or more, or ``long_run`` bytes or more;
    ``first_doc_id`` is the smallest document that holds a chunk of it.
    Repeated rows give a passage once.  Null, empty and short texts have none;
    an empty table gives an empty result; extra columns are ignored.
    """
    return (_passages(docs, min_words, long_run, id_col, text_col).drop("h").withColumnRenamed("id", id_col))


def _passages(docs: DataFrame, min_words: int, long_run: int, id_col: str, text_col: str) -> DataFrame:
    """``repeated_passages`` by ``id`` and text hash ``h``."""
    chunks = chunk_rows(docs, id_col, text_col)
    known = checkpointed(
        chunks.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min("id").alias("first"))
        .where("n > 1").select(F.col("d1").alias("k1"), F.col("d2").alias("k2"), "first"))
    repeats = (chunks.join(known, (F.col("d1") == F.col("k1")) & (F.col("d2") == F.col("k2")))
               .where(~(F.col("id").eqNullSafe(F.col("first")) & (F.col("packed") % 2 == 1))))
    # Runs: the windows hold the repeats of one text; n_before is equal along a run.
    text = Window.partitionBy("id", "h")
    repeats = repeats.select("id", "h", "packed", "first").distinct().select(
        "id", "h", "first", F.shiftright("packed", 22).cast("int").alias("start"),
        (F.shiftright("packed", 11) % 2048).cast("int").alias("size"),
        (F.shiftright("packed", 1) % 1024).cast("int").alias("words"))
    runs = (repeats.withColumn("gap", F.coalesce(
        (F.col("start") != F.lag(F.col("start") + F.col("size")).over(text.orderBy("start"))).cast("int"), F.lit(1)))
        .withColumn("run", F.sum("gap").over(text.orderBy("start"))))
    return (runs.groupBy("id", "h", "run")
            .agg(F.min("start").alias("byte_start"), F.max(F.col("start") + F.col("size")).alias("byte_end"),
                 F.sum("words").alias("n_words"), F.count("*").alias("n_chunks"), F.min("first").alias("first_doc_id"))
            .where((F.col("n_words") >= min_words) | (F.col("byte_end") - F.col("byte_start") >= long_run))
            .select("id", "h", "byte_start", "byte_end", "n_words", "n_chunks", "first_doc_id"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                   text_col: str = "text", long_run: int = LONG_RUN) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text_col``; all columns and rows are kept.

    Passages belong to an id and a text, so rows that share an id (or have
    none) are cut each by its own.  Null and empty texts stay as they are;
    repeated rows are cut alike; an empty table gives an empty result; columns
    may have any names.
    """
    cuts = (_passages(docs, min_words, long_run, id_col, text_col)
            .groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct("byte_start", "byte_end"))).alias("cuts")))

    @pandas_udf("string")
    def cut(text: pd.Series, cuts: pd.Series) -> pd.Series:
        def one(t, spans):
            raw, out, at = t.encode("utf-8", "surrogatepass"), [], 0
            for s in spans:
                out.append(raw[at:s["byte_start"]])
                at = s["byte_end"]
            return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")
        return pd.Series([t if t is None or c is None else one(t, c) for t, c in zip(text, cuts)], dtype=object)

    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text_hash = F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")))
    joined = row.join(cuts, F.col(f"row.`{id_col}`").eqNullSafe(F.col("id")) & (text_hash == F.col("h")), "left")
    new = F.when(F.col("cuts").isNull(), F.col(f"row.`{text_col}`")).otherwise(
        cut(F.col(f"row.`{text_col}`"), F.col("cuts")))
    return joined.select(*[(new if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
