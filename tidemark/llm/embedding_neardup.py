"""Embedding near-duplicates: an exact metric range join.

Vectors are scaled to unit length, where cosine >= c is Euclidean distance
<= eps = sqrt(2 - 2c).  Large labels get pivots (a keyed-hash sample of their
vectors); a vector's home cell is that of its nearest pivot.  If u and v link
and v's home is a, then d(v, b) <= d(v, a) + 2 eps for u's home b (triangle
inequality): v also visits the cells of smaller number for which that holds.
Every pair thus meets in exactly one cell, the smaller of its homes, and
cells join independently.  Within a cell a second triangle inequality,
|d(u, pivot) - d(v, pivot)| <= eps, bounds the rows that are compared.

Crowded cells are cut into blocks, and every pair of blocks is a group of its
own, so no task holds a whole cell.  A group returns link counts per vector
and a spanning forest of its links (one row per member), never its pairs.
Equal vectors of a label (by a 128-bit digest) are one class throughout and
count by weight.

Random high-dimensional vectors lie at nearly equal distances, where no
metric bound can tell them apart; then most vectors visit most cells of their
label and the work nears that of comparing a label's pairs in blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, connected_components, shipped

MIN_COSINE = 0.93
#: Classes per pivot, and rows of a block.
CELL_ROWS = 4096
#: Pivots of all labels together at most (cells grow beyond): the size bound of the broadcast.
MAX_PIVOTS = 8192
#: So many cells of several groups (a few numbers each) at most are broadcast; more are joined by key.
BROADCAST_CELLS = 100_000
#: Slack for rounding in distance bounds; links themselves are decided by the cosine.
SLACK = 1e-9


def unit_vector(values) -> bytes | None:
    """Unit vector as float64 bytes; None for null, empty, zero or non-finite vectors."""
    if values is None or any(x is None for x in values):
        return None
    v = np.array(values, np.float64)
    top = np.abs(v).max() if v.size else 0.0
    if not v.size or not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return (v / math.sqrt(float(v @ v)) + 0.0).tobytes()  # + 0.0: no negative zeros


def _unit_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    fields = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                            F.col(f"`{vector_col}`").alias("v"))
    schema = (f"id {fields.schema['id'].dataType.simpleString()}, label {fields.schema['label'].dataType.simpleString()}"
              ", unit binary, key binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            unit = [unit_vector(v.as_py()) for v in b.column(2)]
            key = [None if u is None else hashlib.blake2b(u, digest_size=16).digest() for u in unit]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(unit, pa.binary()),
                                              pa.array(key, pa.binary())], names=["id", "label", "unit", "key"])

    return fields.mapInArrow(run, schema)


def _forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links, per index."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def join_group(x: np.ndarray, dist: np.ndarray, weight: np.ndarray, side: np.ndarray, cosine: float,
               eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Link weight and component (smallest index) of each row of a group.

    Rows of side 0 are compared with those of side 1; rows of side 2 with one another."""
    n, links = len(x), np.zeros(len(x), np.int64)
    own = np.flatnonzero(side != 1)
    own = own[np.argsort(dist[own], kind="stable")]
    other = np.flatnonzero(side != 0)
    other = other[np.argsort(dist[other], kind="stable")]
    among = bool((side == 2).any())
    left, right, held = [], [], 0
    for lo in range(0, len(own), 512):
        i = own[lo:lo + 512]
        a = np.searchsorted(dist[other], dist[i[0]] - eps - SLACK)
        b = np.searchsorted(dist[other], dist[i[-1]] + eps + SLACK, "right")
        j = other[a:b]
        near = x[i] @ x[j].T >= cosine
        if among:
            near &= i[:, None] != j[None, :]
        links[i] += near @ weight[j]
        if not among:
            links[j] += weight[i] @ near
        p, q = np.nonzero(near)
        left.append(i[p])
        right.append(j[q])
        held += len(p)
        if held > 1 << 21:
            label = _forest(n, np.concatenate(left), np.concatenate(right))
            moved = np.flatnonzero(label != np.arange(n))
            left, right, held = [moved], [label[moved]], len(moved)
    if not held:
        return links, np.arange(n)
    return links, _forest(n, np.concatenate(left), np.concatenate(right))


def _pivots(classes: DataFrame, cell_rows: int, max_pivots: int) -> dict:
    """Pivots by label, for labels of more than a cell's rows: ``max_pivots`` vectors in all, but for chance."""
    total = classes.count()
    share = max(cell_rows, -(-total // max_pivots))
    large = classes.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > share)
    large = large.select(F.col("label").alias("l"), (F.ceil(F.col("n") / share) / F.col("n")).alias("rate"))
    # Labels above a cell's rows number less than max_pivots: a side of bounded size.
    chance = F.pmod(F.xxhash64("unit", F.lit(17)), F.lit(1 << 52)) / float(1 << 52)
    picked = (classes.join(F.broadcast(large), F.col("label") == F.col("l")).where(chance < F.col("rate"))
              .select("label", "unit").collect())
    out: dict = {}
    for r in sorted(picked, key=lambda r: r.unit):
        out.setdefault((r.label, len(r.unit)), []).append(np.frombuffer(r.unit))
    return {k: np.stack(v) for k, v in out.items()}


def embedding_neardup(vectors: DataFrame, min_cosine: float = MIN_COSINE, id_col: str = "vec_id",
                      vector_col: str = "embedding", label_col: str = "label", cell_rows: int = CELL_ROWS,
                      max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Rows of equal, non-null label link at ``min_cosine`` or more; vectors of
    unequal length never do.  Null, zero and empty vectors and those with null
    or non-finite parts link with nothing and are their own component.
    ``n_links`` counts other rows, copies and repeated rows included;
    ``component_id`` is the smallest id reachable by links (null ids name no
    component unless they are alone); ``kept``: the row's id names its
    component.  An empty table gives an empty result; extra columns are ignored.
    """
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must be above 0 and at most 1")
    spark = vectors.sparkSession
    eps = math.sqrt(2 - 2 * min_cosine)
    rows = _unit_rows(vectors, id_col, vector_col, label_col)
    id_kind = rows.schema["id"].dataType.simpleString()
    label_kind = rows.schema["label"].dataType.simpleString()
    classes = checkpointed(
        rows.where("label is not null and unit is not null").groupBy("label", "key")
        .agg(F.first("unit").alias("unit"), F.min("id").alias("least"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()))
    pivots = shipped(spark, _pivots(classes, cell_rows, max_pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(label, size, cell, visit, cid, copies, unit, dist) for the home cell and those visited."""
        for b in batches:
            label, unit = b.column(0).to_pylist(), b.column(1).to_pylist()
            by: dict = {}
            for i, k in enumerate(zip(label, map(len, unit))):
                by.setdefault(k, []).append(i)
            who, cell, visit, dist = [], [], [], []
            for k, at in by.items():
                p, at = pivots().get(k), np.array(at)
                if p is None:
                    who.append(at)
                    cell.append(np.zeros(len(at), np.int64))
                    visit.append(np.zeros(len(at), bool))
                    dist.append(np.zeros(len(at)))
                    continue
                for lo in range(0, len(at), 1024):
                    part = at[lo:lo + 1024]
                    x = np.stack([np.frombuffer(unit[i]) for i in part])
                    d = np.sqrt(np.maximum(0, 2 - 2 * (x @ p.T)))
                    home = d.argmin(axis=1)
                    near = d <= d[np.arange(len(x)), home][:, None] + 2 * eps + SLACK
                    near &= np.arange(d.shape[1])[None, :] <= home[:, None]
                    i, c = np.nonzero(near)
                    who.append(part[i])
                    cell.append(c)
                    visit.append(c != home[i])
                    dist.append(d[i, c])
            if who:
                w = pa.array(np.concatenate(who))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(w), pa.array(np.array([len(u) for u in unit])[np.concatenate(who)]),
                     pa.array(np.concatenate(cell)), pa.array(np.concatenate(visit)), b.column(2).take(w),
                     b.column(3).take(w), b.column(1).take(w), pa.array(np.concatenate(dist))],
                    names=["label", "size", "cell", "visit", "cid", "copies", "unit", "dist"])

    cells = classes.select("label", "unit", "cid", "copies").mapInArrow(
        assign, f"label {label_kind}, size long, cell long, visit boolean, cid long, copies long, unit binary, dist double")
    # Blocks of each cell; cells of one home block and no visitor need no entry.
    sizes = checkpointed(
        cells.groupBy("label", "size", "cell").agg(
            F.ceil(F.count_if(~F.col("visit")) / cell_rows).cast("int").alias("homes"),
            F.ceil(F.count_if("visit") / cell_rows).cast("int").alias("visits"))
        .where("homes > 1 or visits > 0")
        .select(F.col("label").alias("l"), F.col("size").alias("z"), F.col("cell").alias("c"), "homes", "visits"))
    n_sizes = sizes.count()
    if n_sizes:
        side = F.broadcast(sizes) if n_sizes <= BROADCAST_CELLS else sizes
        placed = cells.join(side, (F.col("label") == F.col("l")) & (F.col("size") == F.col("z"))
                            & (F.col("cell") == F.col("c")), "left")
    else:
        placed = cells.withColumns({"homes": F.lit(None).cast("int"), "visits": F.lit(None).cast("int")})
    placed = placed.withColumns({"homes": F.coalesce("homes", F.lit(1)), "visits": F.coalesce("visits", F.lit(0))})
    placed = placed.withColumn("s", F.expr("cast(pmod(xxhash64(cid), if(visit, visits, homes)) as int)"))
    # A home block meets every home block (kind 0) and every visiting block (kind 1) of its cell.
    struct = "named_struct('kind', {}, 'i', {}, 'j', {}, 'side', {})"
    home = (f"transform(sequence(0, homes - 1), t -> {struct.format(0, 'least(s, t)', 'greatest(s, t)', 'case when s = t then 2 when s < t then 0 else 1 end')})")
    meet = f"if(visits = 0, array(), transform(sequence(0, visits - 1), t -> {struct.format(1, 's', 't', 0)}))"
    guest = f"if(homes = 0, array(), transform(sequence(0, homes - 1), t -> {struct.format(1, 't', 's', 1)}))"
    placed = placed.withColumn("g", F.explode(F.expr(f"if(visit, {guest}, concat({home}, {meet}))")))
    groups = placed.select("label", "size", "cell", "g.kind", "g.i", "g.j", "g.side", "cid", "copies", "unit", "dist")

    def join(pdf):
        x = np.frombuffer(b"".join(pdf["unit"]), np.float64).reshape(len(pdf), -1)
        cid = pdf["cid"].to_numpy()
        links, label = join_group(x, pdf["dist"].to_numpy(), pdf["copies"].to_numpy(), pdf["side"].to_numpy(),
                                  min_cosine, eps)
        out = pd.DataFrame({"cid": cid, "links": links, "root": cid[label]})
        return out[(links > 0) | (label != np.arange(len(x)))]

    found = checkpointed(groups.groupBy("label", "size", "cell", "kind", "i", "j")
                         .applyInPandas(join, "cid long, links long, root long"))
    count = found.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    # Written first, like the names: a large component is then a skewed partition of a plain shuffle, which Spark splits.
    by_class = checkpointed(classes.select("label", "key", "least", "copies", "cid").join(count, "cid", "left")
                            .join(comp, F.col("cid") == F.col("node"), "left")
                            .withColumn("root", F.coalesce("component", "cid")).drop("cid", "node", "component"))
    names = checkpointed(by_class.groupBy("root").agg(F.min("least").alias("component_id")))
    by_class = by_class.join(names, "root").select(
        F.col("label").alias("l"), F.col("key").alias("k"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("id", "label", "key").join(
        by_class, (F.col("label") == F.col("l")) & (F.col("key") == F.col("k")), "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").cast(id_kind).alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
