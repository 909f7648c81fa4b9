"""SentencePiece (merge type) encoding with seeded merge-dropout, and decoding.

Encoding keeps an agenda of adjacent pieces whose concatenation is a piece of
the vocabulary and takes the best score, then the leftmost.  With dropout a
candidate taken from the agenda is skipped when a keyed hash of (seed, text,
the word's place in it, the candidate's first character, the pieces left, the
piece it makes) falls below the rate, in words of any length alike; it
returns only if a neighbour changes.  So every occurrence of a word is varied
on its own, and equal texts are segmented alike.  The hash makes the choice
repeatable on any cluster and after any retry.  All segmentations decode to the same text: white space is
escaped as in the vocabulary, characters without a piece (and a literal
escape character) become byte pieces.

A word's decisions form a binary tree, which its occurrences share: each
follows its own hashes down to a leaf that holds the pieces.  Branches are
grown when an occurrence first needs them; words of one width then form a
matrix and take one agenda step each at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import map_rows, shipped
from .token_counts import _portions

SPACE = "▁"
NONE = np.int32(2**31 - 1)
#: Segmentations and decisions that one task remembers; when either is full, the memo starts anew.
MEMO, DECISIONS = 1_200_000, 4_000_000
#: Words of more characters are merged by a heap, each occurrence by itself, with the same decisions.
LONG = 256

# Words that no piece can cross if the vocabulary keeps letters and other characters apart.
_APART = r" *(?:[^\W\d_²³¹¼½¾]+|[\W\d_²³¹¼½¾](?<! )(?:(?! )[\W\d_²³¹¼½¾])*)| +"
_SPACED = r" *[^ ]+| +"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pieces:
    """Pieces of a merge-type model: numbers, priorities of merges and bytes."""

    def __init__(self, pieces: list[str], scores: list[float], plain: list[bool], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces, byte_ids
        number = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.number = number
        self.base = len(pieces)
        places = {s: i for i, s in enumerate(sorted({scores[i] for i in number.values()}, reverse=True))}
        # Characters without a piece of their own can still be halves of one.
        self.extra: dict[str, int] = {}
        halves = lambda s: number.get(s) if len(s) > 1 else self._symbol(s)
        found = []
        for p, i in number.items():
            for k in range(1, len(p)):
                a, b = halves(p[:k]), halves(p[k:])
                if a is not None and b is not None:
                    found.append((a << 32 | b, places[scores[i]], i))
        found.sort()
        self.pairs = np.array([f[0] for f in found] + [2**62], np.int64)
        self.rank = np.array([f[1] for f in found] + [NONE], np.int32)
        self.result = np.array([f[2] for f in found] + [0], np.int64)
        whole = re.compile(_APART)
        apart = all(whole.fullmatch(p.replace(SPACE, " ")) for p in number)
        if any(SPACE in p.lstrip(SPACE) for p in number):
            raise ValueError("pieces that hold white space behind other characters are not supported")
        self.word_pattern = _APART if apart else _SPACED
        # Characters of each piece; one for whatever has no piece.
        self.chars = np.array([len(p) for p in pieces] + [1], np.int64)
        self.raw = [p.replace(SPACE, " ").encode("utf-8") if plain[i] else b"" for i, p in enumerate(pieces)]
        for value, i in enumerate(byte_ids):
            self.raw[i] = bytes([value])

    def _symbol(self, c: str) -> int:
        i = self.number.get(c)
        return i if i is not None else self.extra.setdefault(c, self.base + len(self.extra))

    @classmethod
    def from_model(cls, path: str) -> "Pieces":
        """Read a merge-type model with byte fallback and identity normalisation
        (driver side; bounded by the file)."""
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(m.get_piece_size())
        by_piece = {m.id_to_piece(i): i for i in n if m.is_byte(i)}
        if len(by_piece) != 256:
            raise ValueError("a model with byte fallback is needed")
        plain = [not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i)) for i in n]
        return cls([m.id_to_piece(i) for i in n], [m.get_score(i) for i in n], plain,
                   [by_piece[f"<0x{b:02X}>"] for b in range(256)])

    def decode(self, ids: list[int]) -> str:
        """Text of a piece sequence; the blank put before the text is taken off."""
        out = b"".join(map(self.raw.__getitem__, ids))
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "surrogatepass")


class Encoder:
    """Encodes many texts; one per task."""

    #: Numbered keys of a word that ``_merge`` is checked with; texts do not use them.
    variants = 4

    def __init__(self, pieces: Pieces, dropout: float = 0.0, seed: int = 0):
        if not 0 <= dropout <= 1:
            raise ValueError("dropout must be between 0 and 1")
        self.p, self.dropout, self.seed = pieces, dropout, seed
        self.words = re.compile(pieces.word_pattern).findall
        self._forget()

    def _forget(self) -> None:
        self.root: dict[str, int] = {}
        self.leaves: list[bytes] = []
        self.size = 0
        # Per node the candidate taken, hashed, and the nodes after go and skip: -1 not grown, -2 - i leaf i.
        self.spot, self.child = np.zeros(1 << 16, np.uint64), np.full(1 << 17, -1, np.int32)

    def _nodes(self, n: int) -> np.ndarray:
        """Numbers of ``n`` new nodes."""
        new = np.arange(self.size, self.size + n)
        self.size += n
        if self.size > len(self.spot):
            more = max(self.size, 2 * len(self.spot)) - len(self.spot)
            self.spot = np.concatenate([self.spot, np.zeros(more, np.uint64)])
            self.child = np.concatenate([self.child, np.full(2 * more, -1, np.int32)])
        return new

    def keys(self, text: str, n: int) -> np.ndarray:
        """A key for each of the ``n`` words of a text."""
        base = np.uint64(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), self.seed))
        return _mix(base + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Piece numbers of each text, as little-endian 32-bit integers."""
        cut = [self.words(" " + t) if t else [] for t in texts]
        words = [w for c in cut for w in c]
        if self.dropout:
            keys = np.concatenate([np.zeros(0, np.uint64), *(self.keys(t, len(c)) for t, c in zip(texts, cut))])
        else:
            keys = np.zeros(len(words), np.uint64)
        done, out, lo = self._cut(words, keys), [], 0
        for c in cut:
            out.append(b"".join(done[lo:lo + len(c)]))
            lo += len(c)
        return out

    def _merge(self, words: list[str], variant: int) -> list[bytes]:
        """Pieces of words under their keys of one number."""
        return self._cut(words, np.array([xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"),
                                                                 self.seed * 31 + variant) for w in words], np.uint64))

    def _cut(self, words: list[str], keys: np.ndarray) -> list[bytes]:
        """Pieces of each occurrence of a word under its key."""
        if len(self.leaves) > MEMO or self.size > DECISIONS:
            self._forget()
        root = self.root
        new = [w for w in set(words).difference(root) if len(w) <= LONG]
        root.update(zip(new, self._nodes(len(new)).tolist()))
        node = np.array([root.get(w, -1) for w in words], np.int64)
        end = np.full(len(words), -1, np.int64)
        at = np.flatnonzero(node >= 0)
        here = node[at]
        while len(at):
            here = self.child[2 * here + self._fires(keys[at], self.spot[here])]
            on = here >= 0
            end[at[~on]] = here[~on]
            at, here = at[on], here[on].astype(np.int64)
        missed = np.flatnonzero((end == -1) & (node >= 0))
        if len(missed):
            first, where, of = np.unique(node[missed], return_index=True, return_inverse=True)
            end[missed] = self._grow([words[i] for i in missed[where].tolist()], first, of, keys[missed])
        leaves, long = self.leaves, {}
        out = [leaves[i] if i >= 0 else b"" for i in (-2 - end).tolist()]
        for i in np.flatnonzero(node < 0).tolist():
            # Occurrences under one key (words of equal texts) share their pieces.
            w, key = words[i], int(keys[i])
            if (w, key) not in long:
                code, bytes_of = self._codes([w])
                long[w, key] = self._finish(self._merge_long([code[c] for c in w], key), bytes_of)
            out[i] = long[w, key]
        return out

    def _codes(self, words: list[str]) -> tuple[dict[str, int], dict[int, bytes]]:
        """Numbers of the characters of some words, and the bytes of those without a piece."""
        p = self.p
        fresh: dict[str, int] = {}  # characters that no piece holds

        def symbol(c: str) -> int:
            # A literal escape character stands for itself only as bytes.
            c = SPACE if c == " " else c + "\0" if c == SPACE else c
            i = p.number.get(c)
            if i is None:
                i = p.extra.get(c)
            return i if i is not None else fresh.setdefault(c, p.base + len(p.extra) + len(fresh))

        code = {c: symbol(c) for c in set().union(*words)}
        return code, {i: c[:1].encode("utf-8", "surrogatepass") for c, i in {**p.extra, **fresh}.items()}

    def _grow(self, words: list[str], root: np.ndarray, of: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ends of occurrences (word ``of``, key) in the words' trees, which get the branches they lack.

        A matrix row is a node that some of the occurrences pass."""
        p = self.p
        code, bytes_of = self._codes(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_width.setdefault(len(w), []).append(i)
        order = np.argsort(of, kind="stable")
        start = np.searchsorted(of[order], np.arange(len(words) + 1))
        end = np.zeros(len(of), np.int64)
        # By width: nodes, pieces, ranks of neighbours; occurrences and their rows.
        pool: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for width in range(max(by_width, default=0), 0, -1):
            parts = pool.pop(width, [])
            if width in by_width:
                rows = by_width[width]
                x = np.array([code[c] for i in rows for c in words[i]], np.int64).reshape(len(rows), width)
                here = np.array(rows)
                many = start[here + 1] - start[here]
                parts.append((root[here], x, self._ranks(x[:, :-1], x[:, 1:])[0],
                              np.concatenate([order[start[i]:start[i + 1]] for i in rows]),
                              np.repeat(np.arange(len(rows)), many)))
            if not parts:
                continue
            shift = np.cumsum([0] + [len(z[0]) for z in parts])
            node, x, rank, who, row = (np.concatenate(z) for z in zip(
                *((*z[:4], z[4] + lo) for z, lo in zip(parts, shift))))
            while len(x):
                every = np.arange(len(x))
                at = rank.argmin(axis=1) if width > 1 else np.zeros(len(x), np.int64)
                live = rank[every, at] < NONE if width > 1 else np.zeros(len(x), bool)
                if not live.all():
                    over = ~live
                    self._leaf(node[over], x[over], width, bytes_of)
                    gone = over[row]
                    end[who[gone]] = self.child[2 * node[row[gone]]]
                    who, row = who[~gone], (np.cumsum(live) - 1)[row[~gone]]
                    node, x, rank, at = node[live], x[live], rank[live], at[live]
                    every = np.arange(len(x))
                if not len(x):
                    break
                made = p.result[self._ranks(x[every, at], x[every, at + 1])[1]]
                before = np.arange(width)[None, :] < at[:, None]
                place = (p.chars[np.minimum(x, p.base)] * before).sum(axis=1)
                self.spot[node] = self._spot(made, place, width)
                skip = self._fires(keys[who], self.spot[node[row]])
                some, near = self._branch(node, row[~skip], 0)
                if len(some):
                    pool.setdefault(width - 1, []).append(
                        (near, *self._merged(x[some], rank[some], at[some], made[some]), who[~skip],
                         np.searchsorted(some, row[~skip])))
                some, node = self._branch(node, row[skip], 1)
                who, row = who[skip], np.searchsorted(some, row[skip])
                x, rank = x[some], rank[some]
                rank[np.arange(len(some)), at[some]] = NONE
        return end

    def _branch(self, node: np.ndarray, row: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that have occurrences, and their nodes after the decision, new where there are none."""
        has = np.zeros(len(node), bool)
        has[row] = True
        some = np.flatnonzero(has)
        slot = 2 * node[some] + skip
        lacks = self.child[slot] < 0
        new = self._nodes(int(lacks.sum()))
        self.child[slot[lacks]] = new
        return some, self.child[slot].astype(np.int64)

    def _leaf(self, node: np.ndarray, x: np.ndarray, width: int, bytes_of: dict[int, bytes]) -> None:
        """The pieces of finished rows become leaves, unless they are already."""
        new = self.child[2 * node] == -1
        node, x = node[new], x[new]
        number = -2 - len(self.leaves) - np.arange(len(node))
        self.child[2 * node] = self.child[2 * node + 1] = number
        odd, data, size = (x >= self.p.base).any(axis=1).tolist(), x.astype("<i4").tobytes(), 4 * width
        self.leaves.extend(self._finish(x[k], bytes_of) if odd[k] else data[k * size:(k + 1) * size]
                           for k in range(len(node)))

    def _merged(self, x, rank, at, made):
        n, width = x.shape
        every = np.arange(n)
        x[every, at] = made
        keep = np.ones((n, width), bool)
        keep[every, at + 1] = False
        x = x[keep].reshape(n, width - 1)
        keep = np.ones((n, width - 1), bool)
        keep[every, at] = False
        rank = rank[keep].reshape(n, width - 2)
        for side, rows in ((at - 1, np.flatnonzero(at > 0)), (at, np.flatnonzero(at < width - 2))):
            q = side[rows]
            rank[rows, q] = self._ranks(x[rows, q], x[rows, q + 1])[0]
        return x, rank

    def _ranks(self, left, right):
        key = left << 32 | right
        at = np.searchsorted(self.p.pairs, key)
        return np.where(self.p.pairs[at] == key, self.p.rank[at], NONE), at

    @staticmethod
    def _spot(made, start, width) -> np.ndarray:
        """Hash of a decision: the piece made, the place of its first character and the pieces left."""
        return _mix(made.astype(np.uint64) << np.uint64(32) ^ np.asarray(start).astype(np.uint64)
                    << np.uint64(16) ^ np.asarray(width).astype(np.uint64))

    def _fires(self, key, spot) -> np.ndarray:
        """Whether occurrences with these keys skip at these decisions."""
        if not self.dropout:
            return np.zeros(len(key), bool)
        return (_mix(key ^ spot) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < self.dropout

    def _skips(self, key, made, start, width) -> np.ndarray:
        """Keyed decisions: the word's key, the piece made, its first character's place and the pieces left."""
        return self._fires(key, self._spot(made, start, width))

    def _merge_long(self, symbols: list[int], key: int) -> np.ndarray:
        """The same agenda for one very long word, as a heap (n log n)."""
        import heapq
        p, part = self.p, list(symbols)
        n = len(part)
        key = np.array([key], np.uint64)
        if not hasattr(p, "by_pair"):
            p.by_pair = {(k >> 32, k & 0xFFFFFFFF): (r, t) for k, r, t in
                         zip(p.pairs[:-1].tolist(), p.rank.tolist(), p.result.tolist())}
        after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
        agenda = [(f[0], i, a, b) for i, (a, b) in enumerate(zip(part, part[1:])) if (f := p.by_pair.get((a, b)))]
        heapq.heapify(agenda)
        left = n
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i] if part[i] == a else -1
            if j < 0 or part[j] != b:
                continue
            made = p.by_pair[a, b][1]
            if self.dropout and self._skips(key, np.array([made]), np.array([i]), left)[0]:
                continue
            part[i], part[j] = made, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            left -= 1
            for q in (before[i], i):
                r = after[q] if q >= 0 else -1
                if r >= 0 and (f := p.by_pair.get((part[q], part[r]))):
                    heapq.heappush(agenda, (f[0], q, part[q], part[r]))
        return np.array([x for x in part if x >= 0], np.int64)

    def _finish(self, ids: np.ndarray, bytes_of: dict[int, bytes]) -> bytes:
        if (ids >= self.p.base).any():
            ids = np.array([j for i in ids.tolist() for j in
                            ([i] if i < self.p.base else [self.p.byte_ids[b] for b in bytes_of[i]])])
        return ids.astype("<i4").tobytes()


def encode_texts(docs: DataFrame, pieces: Pieces, dropout: float = 0.1, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_pieces, ids)`` for every row: the piece numbers of the whole text.

    Null and empty texts have no pieces; null or repeated ids and repeated
    rows are passed through (equal texts are segmented alike); an empty table
    gives an empty result; extra columns are ignored.  Nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return _encode(docs, pieces, dropout, seed, id_col, text_col, f"id {kind}, n_pieces long, ids array<int>",
                   lambda key, text, raw, p: (key, len(raw) // 4, np.frombuffer(raw, "<i4").tolist()))


def encode_report(docs: DataFrame, pieces: Pieces, dropout: float = 0.1, seed: int = 42, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(doc_id, n_pieces, n_chars, ids_sha256, lossless)``: the digest of the piece
    numbers (32-bit little-endian) and whether decoding them gives the text back.
    Nulls and repeats as in ``encode_texts``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def row(key, text, raw, p):
        back = p.decode(np.frombuffer(raw, "<i4").tolist())
        return key, len(raw) // 4, len(text), hashlib.sha256(raw).hexdigest(), back == text

    return _encode(docs, pieces, dropout, seed, id_col, text_col,
                   f"{id_col} {kind}, n_pieces long, n_chars long, ids_sha256 string, lossless boolean", row)


def _encode(docs, pieces, dropout, seed, id_col, text_col, schema, row) -> DataFrame:
    sent = shipped(docs.sparkSession, pieces)  # bounded by the model file

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        encoder = Encoder(sent(), dropout, seed)
        for part in _portions(rows, 1 << 22):
            for (key, _, text), raw in zip(part, encoder.encode([r[2] for r in part])):
                yield row(key, text, raw, sent())

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return map_rows(docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("size"),
                                text.alias("body")), run, schema, batch_rows=1024)


def decode_texts(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the decoded text of ``ids_col`` (null stays null) as ``text_col``."""
    sent = shipped(encoded.sparkSession, pieces)

    @pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else sent().decode(list(x)))

    return encoded.withColumn(text_col, decode(F.col(f"`{ids_col}`")))
