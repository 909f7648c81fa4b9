"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes; where tokens of both end together, the
document is cut into groups and the two tokens are linked.  Finding the common
ends is merging two sorted runs of ends.  The merge path of a document is
divided at equal diagonals: a binary search on a diagonal gives how many ends
of either run come before it, so every piece has the same number of merge
steps, whatever the tokenizers do, and needs nothing of the others but the
token before it.

A document of one piece is aligned where it is encoded.  Pieces of longer ones
are rows of a written table, dealt anew over tasks, and each emits its links,
its inner groups and the open groups at its two ends; a sorted stream stitches
those of one document together, one piece in memory at a time.

Links are counted corpus-wide from the distinct links of each piece (combined
in the task, then by key).  The counts go back to the documents as sorted
arrays when their measured number is small, and by a join on the pair when not.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, shipped
from .token_counts import byte_alphabet
from .token_files import Encoder, scratch_path

#: Merge steps (tokens of both kinds) of a piece.
PIECE = 32_768
#: So many counted pairs (24 bytes each) at most are sent to the tasks; more are joined by key.
SENT_PAIRS = 2_000_000
#: Links held before distinct ones are counted, and distinct ones held before they are passed on.
HELD = 1 << 20


def diagonal(a: np.ndarray, b: np.ndarray, d: int) -> int:
    """How many of ``a`` are among the first ``d`` of both sorted runs; of equal ends that of ``a`` comes first."""
    lo, hi = max(0, d - len(b)), min(d, len(a))
    while lo < hi:
        mid = (lo + hi) // 2
        if a[mid] <= b[d - 1 - mid]:
            lo = mid + 1
        else:
            hi = mid
    return lo


def cuts(a: np.ndarray, b: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """Places ``(i, j)`` in the two runs where pieces of ``piece`` merge steps begin, and the ends."""
    total = len(a) + len(b)
    out = []
    for d in [*range(0, total, piece), total]:
        i = diagonal(a, b, d)
        out.append((i, d - i))
    return out


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in two strictly ascending runs that hold the same end."""
    at = np.searchsorted(b, a)
    hit = np.flatnonzero(at < len(b))
    hit = hit[b[at[hit]] == a[hit]]
    return hit, at[hit]


def pack_links(a: np.ndarray, b: np.ndarray) -> bytes:
    """Distinct links with how often they come: count, pairs ``a << 32 | b`` split in two, times."""
    pair, times = np.unique(a.astype(np.int64) << 32 | b, return_counts=True)
    wide = "<u2" if not len(pair) or max(int(a.max()), int(b.max()), int(times.max())) < 1 << 16 else "<u4"
    return bytes([int(wide[2])]) + b"".join(x.astype(wide).tobytes() for x in (pair >> 32, pair & 0xFFFFFFFF, times))


def unpack_links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(pair, times)`` of packed links."""
    x = np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64).reshape(3, -1)
    return x[0] << 32 | x[1], x[2]


class Aligner:
    """Both tokenizers of a task, the bytes and lengths of their tokens and the rendered ids."""

    def __init__(self, a_spec: bytes, b_model: bytes):
        import sentencepiece
        self.a = Encoder(a_spec, "<u4", special=False)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a_bytes, self.b_bytes = byte_level_tokens(a_spec), piece_tokens(self.b)
        self.a_len, self.b_len = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_bytes, self.b_bytes = (np.array(x, object) for x in (self.a_bytes, self.b_bytes))
        na, nb = len(self.a_len), len(self.b_len)
        # An id followed by a comma within its side of a group; by a bar or semicolon at its end.
        self.text = np.array([b"%d%c" % (i, c) for n, ends in ((na, b",|"), (nb, b",;")) for c in ends for i in range(n)],
                             object)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both kinds for each text; None where there are none or their bytes are not the text's."""
        for text, b in zip(texts, self.b.encode([t or "" for t in texts], num_threads=1)):
            if not text:
                yield None
                continue
            raw = (" " + text).encode("utf-8")
            a, b = np.frombuffer(self.a.encode(" " + text), "<u4"), np.array(b, np.int64)
            same = all(len(x) and n[x].all() and b"".join(t[x].tolist()) == raw
                       for x, n, t in ((a, self.a_len, self.a_bytes), (b, self.b_len, self.b_bytes)))
            yield (a.astype(np.int64), b) if same else None

    def render(self, a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray) -> bytes:
        """Groups that end at the links ``(p, q)``, each with a closing semicolon; tokens before the first belong to it."""
        n, m = p[-1] + 1, q[-1] + 1
        code = np.empty(n + m, np.int64)
        last = np.zeros(n, np.int64)
        last[p] = len(self.a_len)
        code[np.arange(n) + np.repeat(np.append(0, q[:-1] + 1), np.diff(p, prepend=-1))] = a[:n] + last
        last = np.zeros(m, np.int64)
        last[q] = len(self.b_len)
        code[np.arange(m) + np.repeat(p + 1, np.diff(q, prepend=-1))] = 2 * len(self.a_len) + b[:m] + last
        return b"".join(self.text[code].tolist())


def byte_level_tokens(spec: bytes) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer file."""
    given = json.loads(spec)
    if (given.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError("a byte-level tokenizer file is needed")
    to_byte = {c: b for b, c in enumerate(byte_alphabet())}
    vocab = given["model"]["vocab"]
    out = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in given.get("added_tokens") or [])]))
    for s, i in vocab.items():
        if all(c in to_byte for c in s):
            out[i] = bytes(to_byte[c] for c in s)
    return out


def piece_tokens(model) -> list[bytes]:
    """Bytes of each piece of a sentencepiece model: U+2581 is a space, <0xHH> the byte."""
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode("utf-8")
            for i, p in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))]


#: Rows of the first table: whole documents (piece -1) with their result, and pieces of longer ones with their tokens.
CUT = ("row long, doc_id {}, piece int, n_pieces int, n_a long, n_b long, n_groups long, n_links long, sha string, "
       "links binary, a binary, b binary, a_start long, b_start long, a_before int")
#: Rows of the second: pieces aligned.
ALIGNED = ("row long, doc_id {}, piece int, n_pieces int, n_a long, n_b long, n_links long, links binary, head_a binary, "
           "head_b binary, middle binary, tail_a binary, tail_b binary")


def align_piece(aligner: Aligner, a: np.ndarray, b: np.ndarray, a_start: int, b_start: int, a_before: int) -> tuple:
    """``(links, packed links, head a, head b, middle groups, tail a, tail b)`` of one piece.

    A link belongs to the piece of its B token; its A token is in the same
    piece or the one before it (``a_before``, which ends at ``a_start``).
    Without a link all tokens are tail."""
    ends_a, ends_b = a_start + np.cumsum(aligner.a_len[a]), b_start + np.cumsum(aligner.b_len[b])
    split = bool(len(b)) and a_before >= 0 and ends_b[0] == a_start
    if split:       # the diagonal parted a link
        ends_a, a = np.append(a_start, ends_a), np.append(a_before, a)
    p, q = common(ends_a, ends_b)
    ids = lambda x: x.astype("<u4").tobytes()
    packed = pack_links(a[p], b[q])
    skip = 1 if split else 0        # a token of the piece before: linked here, written there
    if not len(p):
        return 0, packed, None, None, b"", ids(a), ids(b)
    i, j, k, m = p[0] + 1, q[0] + 1, p[-1] + 1, q[-1] + 1
    middle = aligner.render(a[i:], b[j:], p[1:] - i, q[1:] - j) if len(p) > 1 else b""
    return len(p), packed, ids(a[skip:i]), ids(b[:j]), middle, ids(a[k:]), ids(b[m:])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``size`` bytes."""
    held, room = [], size
    for r in rows:
        held.append(r)
        room -= 64 + sum(len(x) for x in r if isinstance(x, bytes))
        if room <= 0:
            yield _batch(held, schema)
            held, room = [], size
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch], step: int = 64) -> Iterator[list[tuple]]:
    for b in batches:
        for lo in range(0, b.num_rows, step):
            part = b.slice(lo, step)
            yield list(zip(*(c.to_pylist() for c in part.columns)))


def _map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over lists of tuples, with output in batches bounded by bytes."""
    out = df.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        yield from _batches(fn(_rows(batches)), to_arrow_schema(out))

    return df.mapInArrow(run, out)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Alignment:
    """The written alignment of a corpus: ``documents()`` and ``pairs()``."""

    def __init__(self, docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
                 piece: int = PIECE, sent_pairs: int = SENT_PAIRS):
        self.spark: SparkSession = docs.sparkSession
        self.id_col, self.sent_pairs = id_col, sent_pairs
        self.kind = docs.schema[id_col].dataType.simpleString()
        with open(a_file, "rb") as f, open(b_file, "rb") as g:
            files = shipped(self.spark, (f.read(), g.read()))       # bounded by the vocabulary files

        def cut(parts):
            aligner = Aligner(*files())
            for part in parts:
                for (row, key, _), pair in zip(part, aligner.encode([t for _, _, t in part])):
                    if pair is None:
                        yield row, key, -1, 1, 0, 0, 0, 0, "", pack_links(*[np.zeros(0, np.int64)] * 2), *[None] * 5
                        continue
                    a, b = pair
                    if len(a) + len(b) <= piece:
                        p, q = common(np.cumsum(aligner.a_len[a]), np.cumsum(aligner.b_len[b]))
                        sha = hashlib.sha256(aligner.render(a, b, p, q)[:-1]).hexdigest()
                        yield (row, key, -1, 1, len(a), len(b), len(p), len(p), sha, pack_links(a[p], b[q]), *[None] * 5)
                        continue
                    ends_a, ends_b = np.cumsum(aligner.a_len[a]), np.cumsum(aligner.b_len[b])
                    places = cuts(ends_a, ends_b, piece)
                    for k, ((i, j), (m, n)) in enumerate(zip(places, places[1:])):
                        yield (row, key, k, len(places) - 1, m - i, n - j, None, None, None, None,
                               a[i:m].astype("<u4").tobytes(), b[j:n].astype("<u4").tobytes(),
                               int(ends_a[i - 1]) if i else 0, int(ends_b[j - 1]) if j else 0, int(a[i - 1]) if i else -1)

        def align(parts):
            aligner = Aligner(*files())
            ids = lambda x: np.frombuffer(x, "<u4").astype(np.int64)
            for part in parts:
                for row, key, k, n, n_a, n_b, a, b, a_start, b_start, before in part:
                    yield row, key, k, n, n_a, n_b, *align_piece(aligner, ids(a), ids(b), a_start, b_start, before)

        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                           F.col(f"`{text_col}`").cast("string").alias("body"))
        table = _written(_map(rows, cut, CUT.format(self.kind)), "alignment")
        self.whole = table.where("piece < 0")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        long = table.where("piece >= 0").select("row", "doc_id", "piece", "n_pieces", "n_a", "n_b", "a", "b", "a_start",
                                                "b_start", "a_before")
        self.pieces = _written(_map(long.repartition(parts, "row", "piece"), align, ALIGNED.format(self.kind)),
                               "alignment-pieces")
        self._files, self._counts = files, None

    def pairs(self) -> DataFrame:
        """``(a, b, n)``: how many links corpus-wide hold the ids linked."""
        if self._counts is None:
            def count(parts):
                held, n, known = [], 0, None
                for part in parts:
                    for (links,) in part:
                        held.append(unpack_links(links))
                        n += len(held[-1][0])
                    if n >= HELD:
                        known, held, n = _add(known, held), [], 0
                        if len(known[0]) >= HELD:
                            yield from zip((known[0] >> 32).tolist(), (known[0] & 0xFFFFFFFF).tolist(), known[1].tolist())
                            known = None
                known = _add(known, held)
                yield from zip((known[0] >> 32).tolist(), (known[0] & 0xFFFFFFFF).tolist(), known[1].tolist())

            links = self.whole.select("links").unionByName(self.pieces.select("links"))
            counts = _map(links, count, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
            self._counts = checkpointed(counts)
        return self._counts

    def _scored(self, rows: DataFrame) -> DataFrame:
        """``rows``, keyed by ``(row, piece)``, with ``(n_best, count_sum)`` for their ``links``."""
        pairs = self.pairs()
        best = pairs.groupBy("b").agg(F.max("n").alias("most")).withColumnRenamed("b", "b2")
        marked = pairs.join(best, F.col("b") == F.col("b2")).select(
            "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
        schema = rows.schema.simpleString()[len("struct<"):-1]
        at = rows.columns.index("links")
        if pairs.count() <= self.sent_pairs:
            known = marked.toPandas()
            key = known["a"].to_numpy(np.int64) << 32 | known["b"].to_numpy(np.int64)
            order = np.argsort(key)
            sent = shipped(self.spark, (key[order], known["n"].to_numpy(np.int64)[order],
                                        known["best"].to_numpy(bool)[order]))

            def score(parts):
                keys, n, top = sent()
                for part in parts:
                    for row in part:
                        pair, times = unpack_links(row[at])
                        i = np.searchsorted(keys, pair)
                        yield *row, int(times[top[i]].sum()), int((times * n[i]).sum())

            return _map(rows, score, schema + ", n_best long, count_sum long").drop("links")

        def spread(parts):
            for part in parts:
                for row, k, links in part:
                    pair, times = unpack_links(links)
                    yield from zip([row] * len(pair), [k] * len(pair), (pair >> 32).tolist(),
                                   (pair & 0xFFFFFFFF).tolist(), times.tolist())

        links = _map(rows.select("row", "piece", "links"), spread, "row2 long, piece2 int, a2 int, b2 int, times long")
        # Both sides are plain shuffles of written tables, so Spark can split a pair that most documents hold.
        sums = (links.join(checkpointed(marked), (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")))
                .groupBy("row2", "piece2").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("n")).alias("count_sum")))
        rows = rows.drop("links").join(sums, (F.col("row") == F.col("row2")) & (F.col("piece") == F.col("piece2")),
                                       "left").drop("row2", "piece2")
        return rows.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")})

    def _stitched(self) -> DataFrame:
        """``(row, groups, sha)`` of documents of several pieces, from their pieces in order."""

        def stitch(parts):
            now, left_a, left_b, digest, groups = None, b"", b"", None, 0
            text = lambda x: b",".join(b"%d" % i for i in np.frombuffer(x, "<u4").tolist())
            for part in parts:
                for row, k, n, links, head_a, head_b, middle, tail_a, tail_b in part:
                    if row != now:
                        now, left_a, left_b, digest, groups = row, b"", b"", hashlib.sha256(), 0
                    if links:
                        digest.update((b";" if groups else b"") + text(left_a + head_a) + b"|" + text(left_b + head_b))
                        if middle:
                            digest.update(b";" + middle[:-1])
                        left_a, left_b, groups = tail_a, tail_b, groups + links
                    else:
                        left_a, left_b = left_a + tail_a, left_b + tail_b
                    if k == n - 1:
                        yield row, groups, digest.hexdigest()

        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = self.pieces.select("row", "piece", "n_pieces", "n_links", "head_a", "head_b", "middle", "tail_a", "tail_b")
        return _map(rows.repartition(parts, "row").sortWithinPartitions("row", "piece"), stitch,
                    "row long, groups long, sha string")

    def documents(self) -> DataFrame:
        """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row."""
        whole = self._scored(self.whole.select("row", "doc_id", "piece", "n_a", "n_b", "n_groups", "n_links", "sha",
                                               "links"))
        some = self._scored(self.pieces.select("row", "doc_id", "piece", "n_a", "n_b", "n_links", "links"))
        some = some.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[
            F.sum(c).alias(c) for c in ("n_a", "n_b", "n_links", "n_best", "count_sum")])
        long = some.join(self._stitched().withColumnRenamed("row", "r"), F.col("row") == F.col("r"))
        columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha"]
        out = whole.select(*columns).unionByName(long.withColumnRenamed("groups", "n_groups").select(*columns))
        return out.withColumnsRenamed({"doc_id": self.id_col, "sha": "groups_sha256"})


def _add(known, held: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and their summed times."""
    held = held if known is None else [known, *held]
    if not held:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    times = np.zeros(len(pair), np.int64)
    np.add.at(times, at, np.concatenate([h[1] for h in held]))
    return pair, times


def alignment(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
              piece: int = PIECE, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row.

    ``a_file``: a byte-level tokenizer file, which encodes a space and the
    text; ``b_file``: a sentencepiece model, which adds that space itself;
    special strings inside texts are plain text.  Byte offsets where tokens of
    both end cut the text into groups, and the two tokens that end there are
    linked.  ``n_best``: links whose corpus-wide count is the highest of their
    B id; ``count_sum``: the counts of all links; ``groups_sha256``: of
    ``a1,a2|b1;a3|b2,b3``.  Null and empty texts, and texts whose tokens of
    either kind do not give back a space and the text, have no tokens: zeros
    and an empty string.  Null and repeated ids and repeated rows are passed
    through, and their links count as often; an empty table gives an empty
    result; extra columns are ignored.
    """
    return Alignment(docs, a_file, b_file, id_col, text_col, piece, sent_pairs).documents()
