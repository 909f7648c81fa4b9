"""Token counts of a byte-level BPE vocabulary, by a whole-token shortcut.

A BPE vocabulary string is not always what the merges make of its own bytes,
so the strings that do encode alone as one token are proved once, offline, by
running the merges on each.  A text is cut into pre-tokens by the
vocabulary's pattern; a pre-token among the proven strings counts one without
merging, and only the rest is merged (with a bounded memo, since texts repeat
words).  No shuffle: a count depends on its own text alone.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, shipped

# The pre-token pattern of the vocabulary's byte-level splitter.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens (proven and merged) whose length one task remembers; when full, the merged ones go.
MEMO = 1_000_000
#: Bytes of a pre-token from which the agenda takes over from the matrix.
LONG = 48
NONE = np.int32(2**31 - 1)


def _latin() -> tuple:
    """The pattern for texts of characters below U+0250 with plain classes, several times as fast."""
    kind = {"L": "", "N": "", "s": ""}
    for c in map(chr, range(0x250)):
        for k, p in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s")):
            if regex.fullmatch(p, c):
                kind[k] += re.escape(c)
    L, N, s = kind["L"], kind["N"], kind["s"]
    find = re.compile(f" ?[{L}]+| ?[{N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{s}{L}{N}]+|[{s}]+(?![^{s}])|[{s}]+").findall
    return find, re.compile("[\0-\u024f]*").fullmatch


_LATIN_FIND, _LATIN_ONLY = _latin()


def byte_alphabet() -> list[str]:
    """The printable stand-in for each byte: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Merge ranks over numbered byte strings, the proven whole tokens and the special strings.

    Numbers 0 to 255 are the single bytes; a merge of two numbers has a rank
    and a result.  ``pairs`` are the sorted keys ``left << 32 | right``.
    """

    def __init__(self, merges: list[tuple[bytes, bytes]], strings: list[bytes], special: list[str]):
        number = {bytes([b]): b for b in range(256)}
        for a, b in merges:
            number.setdefault(a + b, len(number))
        key = np.array([number[a] << 32 | number[b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.pairs = np.append(key[order], np.int64(2**62))
        self.rank = np.append(order.astype(np.int32), NONE)
        self.result = np.append(np.array([number[a + b] for a, b in merges], np.int64)[order], 0)
        self.special = sorted(special, key=len, reverse=True)
        strings = sorted({s for s in strings if s})
        self.whole = frozenset(s for s, n in zip(strings, self.merged_lengths(strings)) if n == 1)

    @classmethod
    def from_json(cls, path: str) -> "Vocabulary":
        """Read a tokenizer file with a byte-level BPE model (driver side; the
        vocabulary is bounded by the file and is sent to the tasks)."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = (spec["pre_tokenizer"] or {}).get("type")
        if spec["model"]["type"] != "BPE" or kind != "ByteLevel" or spec["normalizer"]:
            raise ValueError("a byte-level BPE file without normalizer is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or spec["model"].get("ignore_merges"):
            raise ValueError("prefix spaces and ignored merges are not supported")
        to_byte = {c: b for b, c in enumerate(byte_alphabet())}
        raw = lambda s: bytes(to_byte[c] for c in s)
        merges = [tuple(map(raw, m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        special = []
        for t in spec.get("added_tokens") or []:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]:
                raise ValueError("only plain added tokens are supported")
            special.append(t["content"])
        strings = [raw(s) for s in spec["model"]["vocab"] if all(c in to_byte for c in s)]
        return cls(merges, strings, special)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, place in the tables) of each pair; NONE where there is no merge."""
        key = left << 32 | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.rank[at], NONE), at

    def merged_lengths(self, words: list[bytes]) -> list[int]:
        """Number of tokens that the merges leave of each pre-token.

        Words of one length form a matrix; each step merges the best pair of
        every row at once, so all rows stay equally long.
        """
        out = [0] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._merged_length_long(w)
            else:
                by_length.setdefault(len(w), []).append(i)
        for size, places in by_length.items():
            step = max(1, (1 << 19) // max(size, 1))
            for lo in range(0, len(places), step):
                part = places[lo:lo + step]
                for i, n in zip(part, self._merge(b"".join([words[i] for i in part]), size)):
                    out[i] = n
        return out

    def _merge(self, data: bytes, size: int) -> list[int]:
        if size == 0:
            return []
        x = np.frombuffer(data, np.uint8).reshape(-1, size).astype(np.int64)
        done = np.full(len(x), size)
        row = np.arange(len(x))
        rank = self._ranks(x[:, :-1], x[:, 1:])[0]
        while rank.shape[1] and len(x):
            at = rank.argmin(axis=1)
            live = rank[np.arange(len(x)), at] < NONE
            done[row[~live]] = x.shape[1]
            x, rank, row, at = x[live], rank[live], row[live], at[live]
            n, width = x.shape
            if not n:
                return done.tolist()
            every = np.arange(n)
            place = self._ranks(x[every, at], x[every, at + 1])[1]
            keep = np.ones((n, width), bool)
            keep[every, at + 1] = False
            x[every, at] = self.result[place]
            x = x[keep].reshape(n, width - 1)
            keep = np.ones((n, width - 1), bool)
            keep[every, at] = False
            rank = rank[keep].reshape(n, width - 2)
            for side, rows in ((at - 1, np.flatnonzero(at > 0)), (at, np.flatnonzero(at < width - 2))):
                p = side[rows]
                rank[rows, p] = self._ranks(x[rows, p], x[rows, p + 1])[0]
        done[row] = x.shape[1]
        return done.tolist()

    def _merged_length_long(self, word: bytes) -> int:
        """The same with an agenda: n log n for a very long pre-token."""
        part = np.frombuffer(word, np.uint8).astype(np.int64)
        rank, _ = self._ranks(part[:-1], part[1:])
        agenda = [(r, i, a, b) for i, (r, a, b) in enumerate(zip(rank.tolist(), part[:-1].tolist(), part[1:].tolist()))
                  if r < NONE]
        part = part.tolist()
        heapq.heapify(agenda)
        after = list(range(1, len(part))) + [-1]
        before = list(range(-1, len(part) - 1))
        table, left = self._table(), len(part)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i] if part[i] == a else -1
            if j < 0 or part[j] != b:
                continue
            part[i], part[j] = table[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            left -= 1
            for p in (before[i], i):
                q = after[p] if p >= 0 else -1
                if q >= 0 and (found := table.get((part[p], part[q]))):
                    heapq.heappush(agenda, (found[0], p, part[p], part[q]))
        return left

    def _table(self) -> dict:
        if not hasattr(self, "_by_pair"):
            self._by_pair = {(k >> 32, k & 0xFFFFFFFF): (r, t) for k, r, t in
                             zip(self.pairs[:-1].tolist(), self.rank.tolist(), self.result.tolist())}
        return self._by_pair


class Counter:
    """Counts the tokens of texts, many at a time; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.proven = {}
        for s in vocabulary.whole:
            try:
                self.proven[s.decode("utf-8")] = 1
            except UnicodeDecodeError:  # part of a character: never a pre-token
                pass
        self.length = dict(self.proven)
        self.find = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def pre_tokens(self, text: str) -> list[str]:
        return _LATIN_FIND(text) if _LATIN_ONLY(text) else self.find(text)

    def counts(self, texts: list[str]) -> list[int]:
        given, cut = [], []
        for text in texts:
            n, pieces = 0, [text]
            if self.special and self.special.search(text):
                pieces = self.special.split(text)
                n = len(pieces) - 1  # each special string is one token
            given.append(n)
            cut.append([t for p in pieces for t in self.pre_tokens(p)] if len(pieces) > 1 else self.pre_tokens(text))
        rest = list(set().union(*cut).difference(self.length))
        if len(self.length) + len(rest) > MEMO:
            self.length = dict(self.proven)
            rest = list(set().union(*cut).difference(self.length))
        raw = [t.encode("utf-8", "surrogatepass") for t in rest]
        self.length.update(zip(rest, self.vocabulary.merged_lengths(raw)))
        get = self.length.__getitem__
        return [n + sum(map(get, tokens)) for n, tokens in zip(given, cut)]


def _portions(rows: Iterator[tuple], size: int = 1 << 20) -> Iterator[list[tuple]]:
    """Rows in portions of about ``size`` bytes of text."""
    part, room = [], size
    for r in rows:
        part.append(r)
        room -= r[1]
        if room <= 0:
            yield part
            part, room = [], size
    if part:
        yield part


def token_counts(docs: DataFrame, vocabulary: Vocabulary, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row.

    Whole texts, no begin or end tokens, no truncation; special strings
    inside a text count one token each.  Null texts count as empty (0, 0,
    false); null or repeated ids and repeated rows are passed through; an
    empty table gives an empty result; extra columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    sent = shipped(docs.sparkSession, vocabulary)  # bounded by the vocabulary file

    def run(rows):
        counter = Counter(sent())
        for part in _portions(rows):
            for (key, size, _), n in zip(part, counter.counts([r[2] for r in part])):
                yield key, size, n

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    counted = map_rows(docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("size"),
                                   text.alias("body")),
                       run, f"{id_col} {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
