"""Benchmark decontamination by spaced-seed hashing.

A mask picks some token positions of a window and ignores the others, so a
window with substituted tokens still hashes alike under a mask that ignores
them.  The masks below find, at some offset, every 13-token stretch with two
substitutions and every 15-token stretch with three.  Items too short to hold
such a stretch must be found whole, and get masks of their own length
(``whole_masks``): one for every allowed set of substituted places that the
common masks would miss, down to the exact hash of items of one to four
tokens.  Equal hashes of a
document and a benchmark item are hits; around each hit the two token
sequences are compared on that alignment and the longest stretch with at
least ``similarity`` equal tokens is kept if it is long enough.

The benchmark is the stated query set: it is read in blocks of bounded size,
and each block is matched against all documents in place (no shuffle of
texts, no hash of a document leaves its task).
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import map_rows, shipped

#: Token positions that each mask looks at.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8), (0, 1, 3, 6, 7))
MIN_TOKENS = 13
SIMILARITY = 0.8
#: Tokens of benchmark items that one block holds, about: items are dealt to blocks by a hash.
BLOCK_TOKENS = 1_000_000

_WORD = re.compile(r"[^\W_]+")
_FILTER_BITS, _FEW_BITS = 22, 16


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall((text or "").lower())


def whole_masks(n: int, similarity: float = SIMILARITY) -> list[tuple[int, ...]]:
    """Masks that find a whole item of ``n`` tokens where ``MASKS`` would not.

    A found stretch begins and ends with equal tokens, so substitutions are at
    inner places, and as many as leave a share of ``similarity``."""
    allowed = int(n * (1 - similarity) + 1e-9)
    inner = range(1, n - 1)
    out = []
    for places in itertools.combinations(inner, min(allowed, len(inner))):
        gone = set(places)
        if not any(not {o + p for p in m} & gone for m in MASKS for o in range(n - m[-1])):
            out.append(tuple(p for p in range(n) if p not in gone))
    return out


def _seeds(ids: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    """Hash of the masked positions for every window start."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, salt + 1, np.uint64)
    for p in mask:
        h = (h ^ ids[p:p + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Index:
    """Seed hashes and tokens of one block of benchmark items."""

    def __init__(self, items: list[tuple], min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY):
        self.keys = [k for k, _ in items]
        words = [tokens(t) for _, t in items]
        # 0 stands for every word that no item has.
        self.word_id = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) | 1
                        for ws in words for w in ws}
        self.ids = [np.array([self.word_id[w] for w in ws], np.uint64) for ws in words]
        self.seeds = [self._table(mask, m, range(len(self.ids)), _FILTER_BITS) for m, mask in enumerate(MASKS)]
        # Items below the length of a stretch: masks of their own length, at their first token.
        for n in sorted({len(x) for x in self.ids if 0 < len(x) < min(min_tokens, MIN_TOKENS)}):
            mine = [i for i, x in enumerate(self.ids) if len(x) == n]
            self.seeds += [self._table(mask, len(MASKS) + n, mine, _FEW_BITS) for mask in whole_masks(n, similarity)]
        self.least = min((len(mask) for mask, _, h, *_ in self.seeds if len(h)), default=1 << 30)

    def _table(self, mask: tuple[int, ...], salt: int, items, bits: int) -> tuple:
        """A mask, its salt, and its hashes in order with item and place; which leading bits occur."""
        found = [_seeds(self.ids[i], mask, salt) for i in items]
        h = np.concatenate(found) if found else np.empty(0, np.uint64)
        item = np.repeat(np.array(list(items), np.int64), [len(x) for x in found])
        at = np.concatenate([np.arange(len(x)) for x in found]) if found else np.empty(0, np.int64)
        order = np.argsort(h, kind="stable")
        present = np.zeros(1 << bits, bool)
        present[(h >> np.uint64(64 - bits)).astype(np.int64)] = True
        return mask, salt, h[order], item[order], at[order], present, bits

    def overlaps(self, text: str | None, min_tokens: int, similarity: float) -> list[tuple]:
        """Verified overlaps of one text: per item the longest, as
        ``(item index, equal tokens, overlap tokens, start, end)`` in tokens of the text."""
        words = tokens(text)
        if len(words) < self.least:
            return []
        get = self.word_id.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        known = ids != 0
        if int(known.sum()) < self.least:
            return []
        aligned = set()
        for mask, salt, h, item, at, present, bits in self.seeds:
            mine = _seeds(ids, mask, salt)
            place = np.flatnonzero(present[(mine >> np.uint64(64 - bits)).astype(np.int64)])
            if not len(place):
                continue
            lo = np.searchsorted(h, mine[place], "left")
            hi = np.searchsorted(h, mine[place], "right")
            for p, a, b in zip(place[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                aligned.update(zip(item[a:b].tolist(), (p - at[a:b]).tolist()))
        best: dict[int, tuple] = {}
        for i, shift in sorted(aligned):
            mine = self.ids[i]
            if best.get(i, (0, 0))[1] == len(mine):
                continue  # found whole
            lo, hi = max(0, -shift), min(len(mine), len(ids) - shift)
            n, equal, start = longest_overlap(mine[lo:hi] == ids[lo + shift:hi + shift], similarity)
            if n >= min(min_tokens, len(mine)) and n > best.get(i, (0,))[0]:
                best[i] = n, equal, lo + shift + start
        return [(i, equal, n, s, s + n) for i, (n, equal, s) in best.items()]


def longest_overlap(equal: np.ndarray, similarity: float) -> tuple[int, int, int]:
    """Longest stretch that begins and ends with an equal pair and has at least
    ``similarity`` equal pairs: (length, equal pairs, start)."""
    place = np.flatnonzero(equal)
    if not len(place):
        return 0, 0, 0
    # From the a-th to the b-th equal pair: b - a + 1 >= similarity * (place[b] - place[a] + 1).
    gain = np.arange(len(place)) - similarity * place
    low = np.minimum.accumulate(gain)
    best = (0, 0, 0)
    for b in range(len(place)):
        # Earliest a with gain[a] <= gain[b] + 1 - similarity (low falls, so its first such place).
        a = int(np.searchsorted(-low, -(gain[b] + 1 - similarity + 1e-9)))
        if a <= b and place[b] - place[a] + 1 > best[0]:
            best = int(place[b] - place[a] + 1), b - a + 1, int(place[a])
    return best


def benchmark_blocks(items: DataFrame, id_col: str, text_col: str, block_tokens: int):
    """The items in blocks of about ``block_tokens`` tokens, by a hash of the item (equal items are one)."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = items.select(F.col(id_col).alias("k"), body.alias("t")).distinct()
    # A token has a character and a separator, so half the length bounds the tokens.
    size = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-int(size) // (2 * block_tokens)))
    for b in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(blocks)) == b)
        yield [(r.k, r.t) for r in part.orderBy("k", "t").collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS,
                 similarity: float = SIMILARITY, id_col: str = "doc_id", item_col: str = "item_id",
                 text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Overlaps of documents with benchmark items, one row per pair found:
    ``(doc_id, item_id, overlap_tokens, equal_tokens, token_start, token_end)``.

    An overlap has ``min_tokens`` tokens (a whole item, if that is shorter)
    and a share of ``similarity`` equal ones, and begins and ends with equal
    ones.  Null, empty and wordless texts and items match nothing;
    repeated documents and items give one row per pair of ids; null ids are
    kept.  Empty tables give an empty result.  Extra columns are ignored.
    """
    spark = docs.sparkSession
    id_kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = (f"doc_id {id_kind}, item_id {item_kind}, overlap_tokens int, equal_tokens int, "
              "token_start int, token_end int")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    found = None
    for block in benchmark_blocks(benchmark, id_col=item_col, text_col=text_col, block_tokens=block_tokens):
        sent = shipped(spark, Index(block, min_tokens, similarity))

        def run(rows, sent=sent):
            index = sent()
            for key, body in rows:
                for i, equal, n, start, end in index.overlaps(body, min_tokens, similarity):
                    yield key, index.keys[i], n, equal, start, end

        part = map_rows(texts, run, schema)
        found = part if found is None else found.union(part)
    best = F.max(F.struct("overlap_tokens", "equal_tokens", (-F.col("token_start")).alias("neg"), "token_end"))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.overlap_tokens", "b.equal_tokens",
                    (-F.col("b.neg")).alias("token_start"), "b.token_end"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; all columns
    are kept.  Decided by text, in place: equal texts share a fate, ids may be
    null or repeated."""
    min_tokens = options.get("min_tokens", MIN_TOKENS)
    similarity = options.get("similarity", SIMILARITY)
    out = docs
    for block in benchmark_blocks(benchmark, id_col=options.get("item_col", "item_id"),
                                  text_col=options.get("item_text_col", "text"),
                                  block_tokens=options.get("block_tokens", BLOCK_TOKENS)):
        sent = shipped(docs.sparkSession, Index(block, min_tokens, similarity))

        @pandas_udf("boolean")
        def hit(text: pd.Series) -> pd.Series:
            return pd.Series([bool(sent().overlaps(t, min_tokens, similarity)) for t in text], dtype=bool)

        out = out.where(~hit(F.col(f"`{text_col}`").cast("string")))
    return out
