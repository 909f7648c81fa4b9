"""Hard negatives of anchors, by angular triangle filtering.

Components become integers, scores are integer inner products.  Every row
stores its norm and its angles to a few reference directions (rounded to
sixteen bits), and lives in the cell of its nearest one.  For the angle t of
an anchor and a row, and their angles a and b to a reference,
``|a - b| <= t <= min(a + b, 2 pi - a - b)``; the tightest of these over all
references gives an interval of the cosine, and multiplied by the norms one of
the score, widened for rounding.  The same holds for sets of rows by the least
and greatest of their stored angles and norms: for whole cells, which an
anchor visits only where the interval meets its window, and within a cell for
windows of rows that lie next to one another in angle.  Only rows of windows
that overlap are scored, exactly.

Three joins by cell:

1. positives in the anchor's home cell, which give a first bound on its last
   positive's score;
2. positives in the other cells whose interval reaches that bound;
3. negatives in the cells that overlap the score window of a positive.

Of equal vectors of a label only those of smallest id can be among the first
few of any anchor; the others are left out of the joins (not as anchors), which
changes no result.

Cells (of one label in 1 and 2) and their visiting anchors are cut into blocks
of bounded size and every pair of blocks is a group of its own, so a hot label,
cell or vector spreads over tasks.  A group returns the few best of each
anchor, and a window over those picks the result.

Random high-dimensional vectors lie at nearly equal angles, where no angle to
a reference can tell them apart; the work then nears that of scoring all
anchors against all rows in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, shipped

#: Reference directions of the vectors of one length.
REFERENCES = 16
#: Vectors at most, and numbers at most but for sixteen vectors, from which references are chosen.
SAMPLE_ROWS, SAMPLE_NUMBERS = 2048, 1 << 23
#: Rows, numbers and anchors of a block at most; rows of a window.
BLOCK_ROWS, BLOCK_NUMBERS, BLOCK_ANCHORS, WINDOW_ROWS = 8192, 1 << 22, 2048, 64
#: Rows of a block at least, where a table is small for the shuffle's partitions and blocks are cut finer.
LEAST_ROWS = 256
#: Anchors scored together.
CHUNK = 64
#: Norms below this keep every inner product within a long.
MAX_NORM = 2.0 ** 31
#: Stored angles: units of a sixteen-bit number per radian, and what rounding of two of them may hide.
UNIT = 65535 / math.pi
SLACK = 1.1 / UNIT
#: So many blocked cells (a few numbers each) at most are broadcast; more are joined by key.
BROADCAST_CELLS = 100_000
#: Below every score.
NOTHING = -(1 << 62) - 1


def integer_vectors(column: pa.Array, scale: int) -> list[tuple[int, float, bytes] | None]:
    """``(length, norm, integers)`` of each list; None for null lists, lists with null or non-finite parts and
    those whose norm is beyond ``MAX_NORM``.  Integers take one, two or eight bytes each."""
    out: list = [None] * len(column)
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)       # nulls become NaN
    starts = np.concatenate(([0], np.cumsum(lengths)))
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(scale * flat)
        for i in np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)):
            v = flat[starts[i]:starts[i + 1]]
            norm = math.sqrt(float(v @ v)) if len(v) else 0.0
            if norm < MAX_NORM:  # false for NaN and infinity
                top = float(np.abs(v).max()) if len(v) else 0.0
                kind = "<i1" if top < 128 else "<i2" if top < 32768 else "<i8"
                out[i] = (len(v), norm, v.astype(kind).tobytes())
    return out


def matrix(vectors: list[bytes], size: int) -> np.ndarray:
    """Stored vectors of one length as rows of 64-bit integers."""
    out = np.zeros((len(vectors), size), np.int64)
    if size:
        width = np.array([len(v) // size for v in vectors])
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            out[at] = np.frombuffer(b"".join([vectors[i] for i in at]), f"<i{w}").reshape(-1, size)
    return out


def angles_to(x: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Stored (rounded) angles of rows to unit directions; zeros for rows of norm zero."""
    cosine = (x.astype(np.float64) @ references.T) / np.where(norm > 0, norm, 1.0)[:, None]
    out = np.rint(np.arccos(np.clip(cosine, -1, 1)) * UNIT).astype("<u2")
    out[norm == 0] = 0
    return out


def score_bounds(angle: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray, small: np.ndarray,
                 large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Safe bounds of the scores of anchors (stored angles, norms) with sets of rows (range of both)."""
    near = np.zeros((len(norm), len(small)))
    far = np.full(near.shape, np.pi)
    for r in range(angle.shape[1]):
        a, b, c = angle[:, r, None] / UNIT, low[None, :, r] / UNIT, high[None, :, r] / UNIT
        np.maximum(near, np.maximum(a - c, b - a), out=near)
        np.minimum(far, np.where(a + c <= np.pi, a + c, np.where(a + b >= np.pi, 2 * np.pi - a - b, np.pi)), out=far)
    up, down = np.cos(np.clip(near - SLACK, 0, np.pi)), np.cos(np.clip(far + SLACK, 0, np.pi))
    margin = 1e-9 * norm[:, None] * large + 0.5
    most = norm[:, None] * np.where(up >= 0, large, small) * up + margin
    least = norm[:, None] * np.where(down >= 0, small, large) * down - margin
    return least, most


def farthest(unit: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the unit vectors at most, each far in angle from those before it."""
    picked = [0]
    best = unit @ unit[0]
    while len(picked) < min(n, len(unit)):
        at = int(best.argmin())
        if best[at] > 1 - 1e-9:
            break
        picked.append(at)
        best = np.maximum(best, unit @ unit[at])
    return unit[picked]


def _references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Reference directions by vector length, from a keyed-hash sample of bounded size."""
    known = rows.where("norm > 0")
    longest = known.agg(F.max("size")).first()[0]
    if longest is None:
        return {}
    n = max(16, min(SAMPLE_ROWS, SAMPLE_NUMBERS // longest))
    picked = known.orderBy(F.xxhash64("id", "v", F.lit(17))).limit(n).select("size", "norm", "v").collect()
    by_size: dict[int, list] = {}
    for r in sorted(picked, key=lambda r: bytes(r.v)):
        by_size.setdefault(r["size"], []).append(matrix([bytes(r.v)], r["size"])[0] / r.norm)
    return {size: farthest(np.stack(v), REFERENCES) for size, v in by_size.items()}


def first_k(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores, ties by smaller id."""
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


class Block:
    """Rows of a cell, in windows of neighbouring angle to the cell's reference."""

    def __init__(self, rows: pd.DataFrame):
        size, cell = int(rows["size"].iloc[0]), int(rows["cell"].iloc[0])
        angle = np.frombuffer(b"".join(rows["angles"]), "<u2").reshape(len(rows), -1)
        norm = rows["norm"].to_numpy()
        order = np.argsort(angle[:, cell] if cell >= 0 else norm, kind="stable")
        self.x = matrix(rows["v"].tolist(), size)[order]
        ids = rows["id"].to_numpy()
        self.ids = (ids.astype(str) if ids.dtype == object else ids)[order]
        self.rid = rows["rid"].to_numpy()[order]
        self.order = order
        angle, norm = angle[order].astype(np.float64), norm[order]
        self.starts = np.arange(0, len(rows), WINDOW_ROWS)
        self.window = np.arange(len(rows)) // WINDOW_ROWS
        self.low, self.high = (f.reduceat(angle, self.starts, axis=0) for f in (np.minimum, np.maximum))
        self.small, self.large = (f.reduceat(norm, self.starts) for f in (np.minimum, np.maximum))
        self.real = self.x.astype(np.float64)

    def scores(self, anchors: np.ndarray, norm: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact scores of anchors with the rows at these places."""
        if norm.max() * self.large.max() < 2.0 ** 53:      # partial sums too: exact in doubles
            return (anchors.astype(np.float64) @ self.real[at].T).astype(np.int64)
        return anchors @ self.x[at].T


class Anchors:
    def __init__(self, frame: pd.DataFrame, cell: int):
        size = int(frame["size"].iloc[0])
        angle = np.frombuffer(b"".join(frame["angles"]), "<u2").reshape(len(frame), -1)
        order = np.argsort(angle[:, cell], kind="stable") if cell >= 0 else np.arange(len(frame))
        self.frame = frame.iloc[order].reset_index(drop=True)
        self.x = matrix(self.frame["v"].tolist(), size)
        self.angle, self.norm = angle[order].astype(np.float64), self.frame["norm"].to_numpy()

    def chunks(self, block: Block) -> Iterator[tuple]:
        for lo in range(0, len(self.x), CHUNK):
            s = slice(lo, lo + CHUNK)
            yield (self.frame.iloc[s], self.x[s], self.norm[s],
                   *score_bounds(self.angle[s], self.norm[s], block.low, block.high, block.small, block.large))


def best_positives(rows: pd.DataFrame, anchors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of a block, other than the anchor, that reach the anchor's bound ``tau``."""
    out = []
    if len(rows) and len(anchors):
        block = Block(rows)
        for frame, x, norm, _, most in Anchors(anchors, int(rows["cell"].iloc[0])).chunks(block):
            need = frame["tau"].to_numpy(np.int64, copy=True)
            rid = frame["rid"].to_numpy()
            # The window of greatest bound gives a first threshold ...
            for i, w in enumerate(most.argmax(axis=1)):
                at = np.arange(block.starts[w], min(block.starts[w] + WINDOW_ROWS, len(block.x)))
                at = at[block.rid[at] != rid[i]]
                if len(at) >= k:
                    s = block.scores(x[i:i + 1], norm[i:i + 1], at)[0]
                    need[i] = max(need[i], np.partition(s, len(s) - k)[len(s) - k])
            # ... and windows that cannot reach it are not scored.
            reach = most >= need[:, None]
            at = np.flatnonzero(reach.any(axis=0)[block.window])
            if not len(at):
                continue
            scores = block.scores(x, norm, at)
            for i in range(len(x)):
                ok = np.flatnonzero(reach[i][block.window[at]] & (scores[i] >= need[i]) & (block.rid[at] != rid[i]))
                best = ok[first_k(scores[i][ok], block.ids[at[ok]], k)]
                out += [(rid[i], block.ids[at[j]], scores[i][j]) for j in best]
    return pd.DataFrame(out, columns=["rid", "pid", "score"])


def best_negatives(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """For each positive of each anchor the ``k`` best rows of a block within its score window and of another label."""
    out = []
    if len(rows) and len(anchors):
        block = Block(rows)
        code = pd.factorize(pd.concat([rows["label"], anchors["label"]], ignore_index=True), use_na_sentinel=False)[0]
        label = code[:len(rows)][block.order]
        anchors = anchors.assign(code=code[len(rows):])
        for frame, x, norm, least, most in Anchors(anchors, int(rows["cell"].iloc[0])).chunks(block):
            reach = np.array([windows_met(least[i], most[i], p, low, high) for i, p in enumerate(frame["positives"])])
            at = np.flatnonzero(reach.any(axis=0)[block.window])
            if not len(at):
                continue
            scores = block.scores(x, norm, at)
            for i, (rid, mine, positives) in enumerate(zip(frame["rid"], frame["code"], frame["positives"])):
                ok = np.flatnonzero(reach[i][block.window[at]] & (label[at] != mine))
                s = scores[i][ok]
                for rank, p in enumerate(positives):
                    a, b = score_window(int(p), low, high)
                    fit = np.flatnonzero((s >= a) & (s <= b))
                    best = fit[first_k(s[fit], block.ids[at[ok[fit]]], k)]
                    out += [(rid, rank, block.ids[at[ok[j]]], s[j]) for j in best]
    return pd.DataFrame(out, columns=["rid", "place", "nid", "score"])


def score_window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score that is ``low`` to ``high`` hundredths of a positive's."""
    return -(-low * positive // 100), high * positive // 100


def windows_met(least: np.ndarray, most: np.ndarray, positives, low: int, high: int) -> np.ndarray:
    """Sets of rows whose score bounds overlap the window of one of an anchor's positives."""
    met = np.zeros(len(least), bool)
    for p in positives:
        a, b = score_window(int(p), low, high)
        met |= (most >= a) & (least <= b) & (a <= b)
    return met


def _cells(placed: DataFrame) -> dict[int, tuple]:
    """By vector length: cell numbers and the ranges of their rows' angles and norms (bounded by the references)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            pdf = b.to_pandas()
            for (size, cell), part in pdf.groupby(["size", "cell"]):
                angle = np.frombuffer(b"".join(part["angles"]), "<u2").reshape(len(part), -1)
                now = (angle.min(axis=0), angle.max(axis=0), part["norm"].min(), part["norm"].max())
                was = held.get((size, cell), now)
                held[size, cell] = (np.minimum(was[0], now[0]), np.maximum(was[1], now[1]), min(was[2], now[2]),
                                    max(was[3], now[3]))
        rows = [(*k, r, int(v[0][r]), int(v[1][r]), v[2], v[3]) for k, v in held.items() for r in range(len(v[0]))]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(
            rows, columns=["size", "cell", "r", "low", "high", "small", "large"]).astype(
                {"size": "int32", "cell": "int32", "r": "int32", "low": "int32", "high": "int32", "small": "float64",
                 "large": "float64"}), preserve_index=False)

    parts = placed.where("cell >= 0").select("size", "cell", "angles", "norm").mapInArrow(
        run, "size int, cell int, r int, low int, high int, small double, large double")
    out: dict[int, dict] = {}
    for r in (parts.groupBy("size", "cell", "r").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                                     F.min("small").alias("small"), F.max("large").alias("large"))
              .collect()):
        out.setdefault(r["size"], {}).setdefault(r["cell"], []).append(r)
    packed = {}
    for size, cells in out.items():
        names = sorted(cells)
        by = [sorted(cells[c], key=lambda r: r["r"]) for c in names]
        packed[size] = (np.array(names), np.array([[r["low"] for r in c] for c in by], np.float64),
                        np.array([[r["high"] for r in c] for c in by], np.float64),
                        np.array([c[0]["small"] for c in by]), np.array([c[0]["large"] for c in by]))
    return packed


def _visiting(anchors: DataFrame, cells: Callable[[], dict], wanted: Callable) -> DataFrame:
    """Anchors once for every cell to visit (``at``): those of ``wanted(row, cells, least, most)``, and the
    cell of rows without a direction (-1)."""
    schema = anchors.schema.simpleString()[len("struct<"):-1] + ",at:int"
    names = anchors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, at = [], []
            for i, row in enumerate(b.to_pylist()):
                number, low, high, small, large = cells().get(row["size"], (np.zeros(0, int),) + (None,) * 4)
                met = np.zeros(0, bool)
                if len(number):
                    angle = np.frombuffer(row["angles"], "<u2")[None, :].astype(np.float64)
                    least, most = score_bounds(angle, np.array([row["norm"]]), low, high, small, large)
                    met = wanted(row, number, least[0], most[0])
                go = number[met].tolist() + ([-1] if wanted(row, np.array([-1]), np.array([-np.inf]),
                                                            np.array([np.inf]))[0] else [])
                who += [i] * len(go)
                at += go
            taken = b.take(pa.array(who, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(at, pa.int32())], names=[*names, "at"])

    return anchors.mapInArrow(run, schema)


def _meet(anchors: DataFrame, rows: DataFrame, keys: list[str], block_rows: int, fn: Callable, schema: str) -> DataFrame:
    """``fn(rows, anchors)`` for every pair of a block of rows and a block of anchors of equal keys."""
    most_rows = F.greatest(F.lit(64), F.least(F.lit(block_rows), F.lit(BLOCK_NUMBERS) / F.greatest(F.col("size"), F.lit(1))))
    blocks = checkpointed(
        rows.groupBy(*keys).agg(F.count("*").alias("n"))
        .join(anchors.groupBy(*keys).agg(F.count("*").alias("m")), keys)
        .select(*[F.col(k).alias(f"k_{k}") for k in keys], F.ceil(F.col("n") / most_rows).cast("int").alias("nr"),
                F.ceil(F.col("m") / BLOCK_ANCHORS).cast("int").alias("na")))
    side = F.broadcast(blocks) if blocks.count() <= BROADCAST_CELLS else blocks
    same = [F.col(k) == F.col(f"k_{k}") for k in keys]
    block = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    drop = ["nr", "na", *[f"k_{k}" for k in keys]]
    r = rows.join(side, same).withColumn("j", block("nr")).withColumn("i", every("na")).drop(*drop)
    a = anchors.join(side, same).withColumn("i", block("na")).withColumn("j", every("nr")).drop(*drop)
    a = a.toDF(*a.columns)      # columns of its own: both sides come from one table
    by = [*keys, "i", "j"]
    return r.groupBy(*by).cogroup(a.groupBy(*by)).applyInPandas(fn, schema)


def hard_negatives(vectors: DataFrame, anchor: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
                   high: int = 100, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label") -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)`` and the score of two rows is their
    integer inner product; higher ones come first, ties by smaller id.  Rows
    for which ``anchor`` holds are anchors; an anchor's positives are its first
    ``n_positives`` other rows of its label, and of each positive the first
    ``n_negatives`` rows of other labels are returned whose score is ``low`` to
    ``high`` hundredths of the positive's.

    Rows with a null id, label or vector, or a null or non-finite component
    take no part, nor do those whose integers have a norm of 2^31 or more
    (their scores need not fit a long).  Zero and empty vectors score 0;
    vectors of different length are never compared.  Repeated rows count as
    often as they come, and a repeated anchor has its result as often.  No
    anchor, or an empty table, gives an empty result; extra columns are ignored.
    """
    spark = vectors.sparkSession
    fields = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                            F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(f"`{vector_col}`").alias("e"))
    fields = fields.where("id is not null and label is not null and e is not null")
    id_kind, label_kind = (fields.schema[c].dataType.simpleString() for c in ("id", "label"))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = integer_vectors(b.column(3), scale)
            keep = [i for i, f in enumerate(found) if f]
            size, norm, v = zip(*[found[i] for i in keep]) if keep else ((), (), ())
            kept = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), kept.column(2), pa.array(size, pa.int32()),
                                              pa.array(norm, pa.float64()), pa.array(v, pa.binary())],
                                             names=["id", "label", "anchor", "size", "norm", "v"])

    row = f"id {id_kind}, label {label_kind}, anchor boolean, size int, norm double, v binary"
    rows = fields.mapInArrow(numbers, row)
    sent = shipped(spark, _references(rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        references = sent()
        for b in batches:
            size, norm = b.column(3).to_numpy(), b.column(4).to_numpy()
            angles, cell = [b""] * b.num_rows, np.full(b.num_rows, -1, np.int32)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                if s in references:
                    a = angles_to(matrix([b.column(5)[int(i)].as_py() for i in at], int(s)), norm[at], references[s])
                    cell[at] = np.where(norm[at] > 0, a.argmin(axis=1), -1)
                    for i, x in zip(at, a):
                        angles[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(angles, pa.binary())],
                                             names=[*b.schema.names, "cell", "angles"])

    placed = checkpointed(rows.mapInArrow(place, row + ", cell int, angles binary")
                          .withColumn("rid", F.monotonically_increasing_id()))
    cells = shipped(spark, _cells(placed))
    anchors = placed.where("anchor").drop("anchor")
    # Of equal vectors, as many as any anchor can be given: one more for the anchor itself. Spark applies the limit
    # before the shuffle too, so a vector with very many copies moves a few rows per task.
    copy = Window.partitionBy("label", "size", "v").orderBy("id", "rid")
    rows = checkpointed(placed.drop("anchor").withColumn("copy", F.row_number().over(copy))
                        .where(F.col("copy") <= max(n_positives + 1, n_negatives)).drop("copy"))
    rows = rows.withColumn("at", F.col("cell"))
    share = -(-rows.count() // int(spark.conf.get("spark.sql.shuffle.partitions")))
    block_rows = min(BLOCK_ROWS, max(LEAST_ROWS, share))
    of_label = ["label", "size", "at"]
    ranked = Window.partitionBy("rid").orderBy(F.desc("score"), "pid")
    picked = f"rid long, pid {id_kind}, score long"

    def positives(_key, r, a):
        return best_positives(r, a, n_positives)

    home = checkpointed(_meet(anchors.withColumns({"tau": F.lit(NOTHING), "at": F.col("cell")}), rows, of_label,
                              block_rows, positives, picked).withColumn("place", F.row_number().over(ranked))
                        .where(F.col("place") <= n_positives).drop("place"))
    bound = (home.groupBy("rid").agg(F.min("score").alias("tau"), F.count("*").alias("n"))
             .where(F.col("n") == n_positives).select(F.col("rid").alias("b"), "tau"))
    known = anchors.join(bound, F.col("rid") == F.col("b"), "left").drop("b")
    away = _visiting(known.withColumn("tau", F.coalesce("tau", F.lit(NOTHING))), cells,
                     lambda row, number, least, most: (number != row["cell"]) & (most >= row["tau"]))
    found = home.unionByName(_meet(checkpointed(away), rows, of_label, block_rows, positives, picked))
    found = checkpointed(found.withColumn("place", F.row_number().over(ranked) - 1)
                         .where(F.col("place") < n_positives))

    lists = found.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))),
                                                 lambda p: p["score"]).alias("positives"))
    mine = anchors.join(lists.withColumnRenamed("rid", "b"), F.col("rid") == F.col("b")).drop("b")

    def negatives(_key, r, a):
        return best_negatives(r, a, n_negatives, low, high)

    meeting = checkpointed(_visiting(mine, cells, lambda row, number, least, most: windows_met(
        least, most, row["positives"], low, high)))
    best = Window.partitionBy("rid", "place").orderBy(F.desc("score"), "nid")
    taken = (_meet(meeting, rows, ["size", "at"], block_rows, negatives,
                   f"rid long, place int, nid {id_kind}, score long")
             .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives))
    names = found.join(anchors.select(F.col("rid").alias("a"), F.col("id").alias("anchor_id")), F.col("rid") == F.col("a"))
    names = names.select(F.col("rid").alias("a"), "anchor_id", F.col("place").alias("p"), F.col("pid").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return taken.join(names, (F.col("rid") == F.col("a")) & (F.col("place") == F.col("p"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("nid").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
