"""SimHash near-duplicates by segment-popcount embedding.

Every text gets a 64-bit SimHash over word shingles.  A fingerprint is cut
into segments and mapped to the vector of their bit counts; flipping one bit
moves one coordinate by one, so the Manhattan distance of two vectors never
exceeds the Hamming distance.  Links at ``max_distance`` differing bits are
therefore a range join under Manhattan distance on that integer grid,
followed by an exact check of the bits:

* the segments form two halves; of two fingerprints at Hamming distance d,
  one half is at Manhattan distance <= d // 2;
* two grid points at distance r have a point of the grid within ceil(r / 2)
  of both, so each fingerprint visits its own cell and the cells within that
  many unit steps, per half, and all linked fingerprints meet in a cell;
* a cell is checked by vectorised xor + popcount; crowded cells are split
  into blocks and every pair of blocks is a group of its own, so no group is
  unbounded and none is dropped.

A group returns a spanning forest of its exact links (at most one row per
member), never its pairs; components come from distributed star
contractions.  Copies share a fingerprint and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import checkpointed, connected_components, map_rows

#: Bits in a segment; its count is a grid coordinate from 0 to SEGMENT.
SEGMENT = 2
HALF_SEGMENTS = 32 // SEGMENT
BASE = SEGMENT + 1
#: Members of a cell that one group may hold; larger cells are split.
BLOCK = 2048
#: So many crowded cells (two numbers each) at most are broadcast; more are joined by key.
BROADCAST_CELLS = 200_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit SimHash: bit set where over half the shingle hashes (XXH64,
    seed 42) have it.  Words are runs of characters other than ASCII white
    space, A-Z lower-cased.  Null or wordless text: zero; fewer words than
    ``shingle``: one shingle of all words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII space
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[s:e], 42) for s, e in zip(starts[: len(words) - shingle + 1].tolist(),
                                                     ends[shingle - 1:].tolist())]
    total = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[lo: lo + (1 << 15)], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<i8")[0])


def simhash_fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """``(id, fp)`` for every row; ids may be null or repeated and are passed through."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        for key, text in rows:
            yield key, fingerprint(text, shingle)

    return map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")),
                    run, f"id {kind}, fp long")


def _cells(fps: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Grid cells that each fingerprint visits: (index of the fingerprint, cell key)."""
    u = fps.view(np.uint64)
    who, keys = [], []
    mask = np.uint64((1 << SEGMENT) - 1)
    for half in range(2):
        counts = np.empty((len(u), HALF_SEGMENTS), np.int64)
        for k in range(HALF_SEGMENTS):
            shift = np.uint64(32 * half + SEGMENT * k)
            counts[:, k] = np.bitwise_count((u >> shift) & mask)
        place = BASE ** np.arange(HALF_SEGMENTS, dtype=np.int64)
        layer = [(np.arange(len(u)), counts)]
        found_who, found_key = [np.arange(len(u))], [counts @ place]
        for _ in range(steps):
            grown = []
            for idx, c in layer:
                for k in range(HALF_SEGMENTS):
                    for move in (-1, 1):
                        ok = (c[:, k] + move >= 0) & (c[:, k] + move <= SEGMENT)
                        moved = c[ok].copy()
                        moved[:, k] += move
                        grown.append((idx[ok], moved))
                        found_who.append(idx[ok])
                        found_key.append(moved @ place)
            layer = grown
        w, key = np.concatenate(found_who), np.concatenate(found_key) + half * BASE ** HALF_SEGMENTS
        if steps > 1:
            w, key = np.unique(np.stack([w, key]), axis=1)
        who.append(w)
        keys.append(key)
    return np.concatenate(who), np.concatenate(keys)


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member index reachable by the links, per index."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return label


def _links(cell: np.ndarray, side: np.ndarray, fp: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of rows sorted by group; rows of a group with sides 0 and 1
    are compared across, others (side 2) with one another."""
    n, left, right = len(cell), [], []
    u = fp.view(np.uint64)
    live = np.arange(n)
    shift = 1
    while True:
        live = live[live + shift < n]
        live = live[cell[live] == cell[live + shift]]
        if not len(live):
            break
        other = live + shift
        hit = np.bitwise_count(u[live] ^ u[other]) <= max_distance
        hit &= (side[live] != side[other]) | (side[live] == 2)
        left.append(live[hit])
        right.append(other[hit])
        if sum(map(len, left)) > 1 << 20:  # contract what was found so far
            label = _forest(n, np.concatenate(left), np.concatenate(right))
            own = np.flatnonzero(label != np.arange(n))
            left, right = [own], [label[own]]
        shift += 1
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    label = _forest(n, np.concatenate(left), np.concatenate(right))
    own = np.flatnonzero(label != np.arange(n))
    return own, label[own]


def simhash_links(fps: DataFrame, max_distance: int = 4, block: int = BLOCK) -> DataFrame:
    """Spanning links ``(a, b)`` of the distinct fingerprints ``fps(fp)``.

    The links connect exactly the fingerprints that are connected by pairs at
    ``max_distance`` or fewer differing bits; each link's ends are connected.
    """
    radius = max_distance // 2
    steps = -(-radius // 2)
    if not 0 <= max_distance <= 9:
        raise ValueError("max_distance must be between 0 and 9")

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                fp = b.column(0).slice(lo, 4096).to_numpy(zero_copy_only=False).astype(np.int64)
                who, key = _cells(fp, steps)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[who])], names=["cell", "fp"])

    visits = fps.where("fp is not null").mapInArrow(visit, "cell long, fp long")
    crowded = checkpointed(
        visits.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select(F.col("cell").alias("c"), F.ceil(F.col("n") / block).cast("int").alias("k")))
    n_crowded = crowded.count()
    # Pairs of blocks (i <= j) of a crowded cell: a member of block s joins every pair with s.
    if n_crowded:
        side = F.broadcast(crowded) if n_crowded <= BROADCAST_CELLS else crowded
        spread = visits.join(side, F.col("cell") == F.col("c"), "left")
    else:
        spread = visits.withColumn("k", F.lit(None).cast("int"))
    spread = spread.withColumn("s", F.expr("cast(pmod(xxhash64(fp), k) as int)"))
    spread = spread.withColumn("t", F.explode(F.when(F.col("k").isNull(), F.array(F.lit(0)))
                                              .otherwise(F.expr("sequence(0, k - 1)"))))
    spread = spread.select(
        F.when(F.col("k").isNull(), F.col("cell"))
        .otherwise(F.xxhash64("cell", F.least("s", "t"), F.greatest("s", "t"))).alias("grp"),
        F.when(F.col("k").isNull() | (F.col("s") == F.col("t")), 2)
        .when(F.col("s") < F.col("t"), 0).otherwise(1).cast("int").alias("side"), "fp")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for b in batches:
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            # A group may go on in the next batch: keep the last one back.
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut >= 1 << 15:
                yield from emit([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield from emit(held)

    def emit(part):
        grp, side, fp = part[0], part[1].astype(np.int64), part[2].astype(np.int64)
        a, b = _links(grp, side, fp, max_distance)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], names=["a", "b"])

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (spread.repartition(parts, "grp").sortWithinPartitions("grp")
            .mapInArrow(check, "a long, b long"))


def simhash_components(fps: DataFrame, max_distance: int = 4, block: int = BLOCK) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint: ``root`` names its component."""
    distinct = checkpointed(fps.select("fp").distinct())
    comp = connected_components(simhash_links(distinct, max_distance, block))
    return distinct.join(comp, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "fp").alias("root"))


def _with_least(members: DataFrame, value: str) -> DataFrame:
    """``members`` with the least ``value`` of their ``root`` as ``pick``.

    Both sides of the join are written first: a component with a large share
    of all members is then a skewed partition of a plain shuffle, which Spark
    splits."""
    members = checkpointed(members)
    least = checkpointed(members.groupBy("root").agg(F.min(value).alias("pick")))
    return members.join(least, "root")


def simhash_neardup(docs: DataFrame, shingle: int = 4, max_distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``(id, fp, component_id)`` per input row.

    ``component_id`` is the smallest id whose fingerprint is reachable.  Null
    ids keep their row but never name a component (null where a component
    has no other id); repeated rows are returned as often as they came;
    wordless and null texts share fingerprint zero and link like any other.
    An empty table gives an empty result.  Extra columns are ignored.
    """
    fps = checkpointed(simhash_fingerprints(docs, shingle, id_col, text_col))
    comp = simhash_components(fps, max_distance, block)
    first = fps.groupBy("fp").agg(F.min("id").alias("least"))
    by_fp = _with_least(comp.join(first, "fp"), "least").select(F.col("fp").alias("f"), F.col("pick").alias("component_id"))
    return fps.join(by_fp, F.col("fp") == F.col("f")).select("id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_distance: int = 4, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with one document of each near-duplicate group left.

    The document with the smallest id stays (a group of null ids keeps one
    with the smallest fingerprint); of rows with equal id and fingerprint that
    with the smallest text hash, of repeated rows one.  Null and empty texts
    are one group like any other; an empty table gives an empty result.  All
    columns are kept, whatever their names.
    """

    @pandas_udf("long")
    def mark(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in text], dtype="int64")

    fps = checkpointed(simhash_fingerprints(docs, shingle, id_col, text_col))
    comp = simhash_components(fps, max_distance)
    least = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("pick"))
    kept = (comp.join(least, "fp").groupBy("root").agg(F.min("pick").alias("pick"))
            .select(F.concat_ws(":", F.col("pick.id").cast("string"), F.hex("pick.fp")).alias("key")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    keyed = row.withColumn("key", F.concat_ws(":", F.col(f"row.`{id_col}`").cast("string"),
                                              F.hex(mark(F.col(f"row.`{text_col}`").cast("string")))))
    text_hash = F.xxhash64(F.col(f"row.`{text_col}`").cast("string"))
    return keyed.join(kept, "key", "left_semi").groupBy("key").agg(F.min_by("row", text_hash).alias("row")).select("row.*")
