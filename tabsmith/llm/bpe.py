"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary file.

Each match of the split pattern is encoded by itself.  A batch's pieces that
were not seen before are laid out by length in padded numpy matrices of token
ids; in each round every row merges its leftmost pair of minimum rank (pairs
are looked up in an open-addressing hash table), rows are shifted to close the
gap, and rows without a mergeable pair leave the matrix.  Pieces of more than
``LONG_PIECE`` bytes take the same merges from a heap instead, because a row
of n tokens would take n rounds of n steps.

Null text counts as empty: no ids, the digest of no bytes.  Special tokens
are never made.  Texts are never cut.  The vocabulary (about 50,000 entries,
under 1 MB) is read on the driver and broadcast; it does not grow with the
data.  Ids are the ranks of the file and fit 32 bits.
"""

from __future__ import annotations

import hashlib
import heapq
from base64 import b64decode

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabsmith.llm.common import by_value, map_texts

#: Pieces of more bytes than this are merged by a heap.
LONG_PIECE = 256
#: Pieces a task remembers; the memory starts anew when full.
CACHE_PIECES = 1 << 19
#: Ids decoded at once; bounds memory on very long texts.
DECODE_IDS = 1 << 18
#: Tokens in a padded matrix.
MATRIX_TOKENS = 1 << 18

NONE = np.int32(2**31 - 1)  # rank of a pair that does not merge

#: Matches as the public split pattern does in texts of ASCII and Latin letters, which `re` scans twice as fast.
LATIN_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
LATIN_SPLIT = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN_LETTERS}]+| ?[0-9]+| ?[!-/:-@\[-`{{-~]+|\s+(?!\S)|\s+")
NOT_LATIN = rf"[^\t\n\r\x20-\x7e{LATIN_LETTERS}]"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """Rank tables as arrays: token bytes, byte ids and the hashed pair table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        size = max(self.tokens) + 1
        self.token_len = np.full(size, -1, np.int64)
        self.token_len[list(self.tokens)] = [len(b) for b in self.tokens.values()]
        self.token_at = np.zeros(size, np.int64)
        self.token_at[list(self.tokens)] = np.cumsum([0, *(len(b) for b in self.tokens.values())])[:-1]
        self.blob = np.frombuffer(b"".join(self.tokens.values()), np.uint8)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ranks[s[:k]] << 32 | ranks[s[k:]], r) for s, r in ranks.items() if len(s) > 1
                 for k in range(1, len(s)) if s[:k] in ranks and s[k:] in ranks]
        self.size = 1 << max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(self.size, -1, np.int64)
        self.vals = np.full(self.size, NONE, np.int32)
        key, val = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
        slot = self._slot(key)
        left = np.arange(len(key))
        while len(left):  # each round places one key in each free slot that is asked for
            free = left[self.keys[slot[left]] < 0]
            first = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[first]], self.vals[slot[first]] = key[first], val[first]
            left = np.setdiff1d(left, first, assume_unique=True)
            slot[left] = (slot[left] + 1) & (self.size - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        h = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(40)).astype(np.int64) & (self.size - 1)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` where it does not merge (or an id is -1)."""
        key = np.where((a < 0) | (b < 0), np.int64(-2), a.astype(np.int64) << 32 | b)
        out = np.full(key.shape, NONE, np.int32)
        flat, res = key.ravel(), out.ravel()
        todo = np.flatnonzero(flat >= 0)
        slot = self._slot(flat[todo])
        while len(todo):
            there = self.keys[slot]
            hit = there == flat[todo]
            res[todo[hit]] = self.vals[slot[hit]]
            on = ~hit & (there >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (self.size - 1)
        return res.reshape(key.shape)

    def encode_matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32 bytes) of pieces of similar length."""
        lens = np.array([len(p) for p in pieces])
        n, width = len(pieces), int(lens.max())
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lens[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = self.pair_rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 0), NONE, np.int32)
        ranks = np.pad(ranks, ((0, 0), (0, 1)), constant_values=NONE)
        rows, out = np.arange(n), [b""] * n
        cols = np.arange(width)
        while True:
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), at]
            done = low == NONE
            if done.any():
                ended = ids[done]
                flat = ended[ended >= 0].astype("<u4").tobytes()
                ends = 4 * np.cumsum((ended >= 0).sum(axis=1))
                for r, s, e in zip(rows[done].tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    out[r] = flat[s:e]
                go = ~done
                rows, ids, ranks, at, low = rows[go], ids[go], ranks[go], at[go], low[go]
            if not len(rows):
                return out
            me = np.arange(len(rows))
            # close the gap behind the merged pair
            src = np.minimum(cols + (cols > at[:, None]), len(cols) - 1)
            ids = np.take_along_axis(ids, src, 1)
            ids[:, -1] = -1
            ids[me, at] = low
            ranks = np.take_along_axis(ranks, src, 1)
            ranks[:, -1] = NONE
            nxt = np.minimum(at + 1, len(cols) - 1)
            ranks[me, at] = self.pair_rank(low, np.where(at + 1 < len(cols), ids[me, nxt], -1))
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.pair_rank(ids[has, at[has] - 1], low[has])
            keep = max(1, int((ids >= 0).sum(axis=1).max()))
            ids, ranks, cols = ids[:, :keep], ranks[:, :keep], cols[:keep]

    def encode_long(self, piece: bytes) -> bytes:
        """The same merges in order of (rank, place), from a heap over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.pair_rank(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(piece)
        prev, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        memo: dict[tuple[int, int], int] = {}

        def push(i: int, j: int) -> None:
            pair = ids[i], ids[j]
            if pair not in memo:
                memo[pair] = self.ranks.get(self.tokens[pair[0]] + self.tokens[pair[1]], int(NONE))
            if memo[pair] < NONE:
                heapq.heappush(heap, (memo[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # a side has merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                prev[after[j]] = i
                push(i, after[j])
            if prev[i] >= 0:
                push(prev[i], i)
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """Raises ValueError for an id that the vocabulary lacks."""
        out, every = [], np.frombuffer(ids, "<u4").astype(np.int64)
        for at in range(0, len(every), DECODE_IDS):
            part = every[at:at + DECODE_IDS]
            if part.max() >= len(self.token_len) or (self.token_len[part] < 0).any():
                raise ValueError("an id is not in the vocabulary")
            lens = self.token_len[part]
            ends = np.cumsum(lens)
            src = np.repeat(self.token_at[part] - ends + lens, lens) + np.arange(ends[-1])
            out.append(self.blob[src].tobytes())
        return b"".join(out)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(p) > LONG_PIECE:
                out[k] = self.encode_long(p)
            elif p:
                buckets.setdefault((len(p) - 1) // 4, []).append(k)
        for b, which in buckets.items():
            step = max(1, MATRIX_TOKENS // (4 * b + 4))
            for at in range(0, len(which), step):
                part = which[at:at + step]
                for k, got in zip(part, self.encode_matrix([pieces[k] for k in part]), strict=True):
                    out[k] = got
        return out


class Codec:
    """Text to ids and back; remembers the ids of up to ``CACHE_PIECES`` pieces."""

    def __init__(self, merges: Merges, pattern: str, latin_pattern: str | None = None):
        import re

        import regex
        self.merges, self.known = merges, {}
        self.any_text = regex.compile(pattern).findall
        self.odd, self.latin = re.compile(NOT_LATIN).search, re.compile(latin_pattern or "").findall
        if latin_pattern is None:
            self.odd = lambda text: True

    def split(self, text: str) -> list[str]:
        return self.any_text(text) if self.odd(text) else self.latin(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        new = set().union(*split) - self.known.keys()
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known = {}
            new = set().union(*split)
        new = list(new)
        self.known.update(zip(new, self.merges.encode_pieces([p.encode("utf-8", "replace") for p in new]), strict=True))
        get = self.known.__getitem__
        return [b"".join(map(get, s)) for s in split]


def _codec_maker(spark: SparkSession, path: str, pattern: str, latin_pattern: str | None):
    merges = by_value(spark, Merges(load_ranks(path)))
    return lambda: Codec(merges(), pattern, latin_pattern)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
           latin_pattern: str | None = None) -> DataFrame:
    """``docs`` with the ids of every whole text as little-endian uint32 bytes in a binary column.

    ``latin_pattern``: a pattern that splits texts of ASCII and Latin letters
    like ``pattern`` does, for the faster standard matcher.
    """
    make = _codec_maker(docs.sparkSession, path, pattern, latin_pattern)

    def task():
        codec = make()
        return lambda cols: {ids_col: codec.encode([t or "" for t in cols[0]])}
    return map_texts(docs, [text_col], T.StructType([T.StructField(ids_col, T.BinaryType())]), task)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for (null ids: no bytes)."""
    held = by_value(encoded.sparkSession, Merges(load_ranks(path)))

    def task():
        merges = held()
        return lambda cols: {bytes_col: [merges.decode(x or b"") for x in cols[0]]}
    return map_texts(encoded, [ids_col], T.StructType([T.StructField(bytes_col, T.BinaryType())]), task)


DIGEST = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                       T.StructField("decoded_sha256", T.StringType())])


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
               latin_pattern: str | None = None) -> DataFrame:
    """``docs`` with token count and digests of the ids and of the bytes decoded from them.

    One pass: the ids never leave the task, so nothing but digests is written.
    """
    make = _codec_maker(docs.sparkSession, path, pattern, latin_pattern)

    def task():
        codec = make()

        def run(cols):
            ids = codec.encode([t or "" for t in cols[0]])
            return {"n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(codec.merges.decode(x)).hexdigest() for x in ids]}
        return run
    return map_texts(docs, [text_col], DIGEST, task)


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tabsmith.llm.common import read
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                      latin_pattern=LATIN_SPLIT).drop("text")
