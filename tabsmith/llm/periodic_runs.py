"""Periodic runs of words: detection by a descending-LCP Kruskal, and collapsing.

Words are stretches without ASCII white space.  A run is a stretch of words
whose smallest period is q (words q apart are equal), of ``max(min_words,
repeats * q)`` words or more, that no neighbouring word extends with period q.

1. Suffixes of a text's words are sorted by doubling; ranks of every doubling
   are kept, so the common prefix (LCP) of neighbours in the order is found by
   descending through them.
2. A run of n words with period q has two suffixes q apart with an LCP of n - q,
   which is ``least_lcp`` or more.  So only suffixes whose first words (a power
   of two, ``least_lcp`` at most) come again in the text matter: they are found
   by rolling hashes over a whole batch, and only they are refined further.
3. Neighbours in the order are edges, taken by decreasing LCP: union-find joins
   their classes, the smaller ordered position set going into the larger.  Once
   all edges of one LCP are in, positions that have become neighbours in their
   set at a distance within the LCP seed a run: their distance is the smallest
   period there, as a smaller one would have put a position between them earlier.
   Seeds that the word before extends belong to a run that another seed gives.

Texts are mapped alone; there is no shuffle, and memory is bounded by a batch of
texts.  Defined results: a null, empty or blank text has no words, no runs and an
empty text; equal rows give equal results; an empty table gives an empty result.
Columns of the input stay, but ``text``, ``runs`` and ``best`` (in any case).
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from fractions import Fraction
from itertools import count
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import map_texts

MIN_WORDS, REPEATS = 24, 3
#: Words whose suffixes are sorted at once (a longer text alone).
WORDS_AT_ONCE = 1 << 20


def least_lcp(min_words: int, repeats: int) -> int:
    """Least n - q of a run of n words with period q; ``repeats`` is 2 or more."""
    return min(max(min_words - q, (repeats - 1) * q) for q in range(1, min_words + 1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def _shifted(x: np.ndarray, by: int, fill: int) -> np.ndarray:
    out = np.full_like(x, fill)
    if by < len(x):
        out[:-by or None] = x[by:]
    return out


def repeated(ids: np.ndarray, doc: np.ndarray, left: np.ndarray, width: int) -> np.ndarray:
    """Where the next ``width`` words (a power of two) may come again in the same text; true where they do.

    ``left`` counts the words from each position to the end of its text.
    """
    h, w = _mixed(ids), 1
    while w < width:
        h = _mixed(h * np.uint64(0x94D049BB133111EB + 2 * w) + _shifted(h, w, 0))
        w *= 2
    full = np.flatnonzero(left >= width)
    key = h[full] ^ _mixed(doc[full] + (1 << 40))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(ids), bool)
    if not len(full):
        return out
    out[full[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]] = True
    return out


def _ranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the pairs, and for every place in it whether the pair is a new one."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    return order, a, np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])


def sorted_suffixes(ids: np.ndarray, doc: np.ndarray, left: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(x, y, lcp)``: neighbours in the order of each text's suffixes, with common prefixes of ``width`` words or more.

    The rank of a group is the place of its first member; only members of
    groups of several are sorted again after ``width`` words.
    """
    n = len(ids)
    place = np.arange(n)

    def ahead(rank, w, at):
        out = np.full(len(at), -1, np.int64)
        inside = left[at] > w
        out[inside] = rank[at[inside] + w]
        return out
    order, _, new = _ranked(doc, ids)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    levels, w, open_ = [rank], 1, place
    suffix = order
    while len(open_):
        order, base, new = _ranked(rank[open_], ahead(rank, w, open_))
        at = open_[order]
        # places of the members of one group follow each other from the group's rank
        group = np.concatenate([[True], base[1:] != base[:-1]]) if len(base) else new
        within = np.arange(len(at)) - np.maximum.accumulate(np.where(group, np.arange(len(at)), 0))
        spot = base + within
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(new, spot, 0))
        suffix = suffix.copy()
        suffix[spot] = at
        levels.append(rank)
        w *= 2
        if w >= width:
            several = np.zeros(len(at), bool)
            same = ~new
            several[same] = True
            several[:-1] |= same[1:]
            open_ = at[several]
        if w > n:
            break
    wide = levels[width.bit_length() - 1]
    here = np.flatnonzero(wide[suffix][1:] == wide[suffix][:-1])
    x, y = suffix[here], suffix[here + 1]
    lcp = np.zeros(len(x), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left[x] - lcp >= 1 << k) & (left[y] - lcp >= 1 << k)
        at = np.flatnonzero(inside)
        at = at[levels[k][x[at] + lcp[at]] == levels[k][y[at] + lcp[at]]]
        lcp[at] += 1 << k
    return x, y, lcp


def seeds(x: np.ndarray, y: np.ndarray, lcp: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """``(start, distance, lcp)`` of positions that become neighbours in a class at a distance within its LCP."""
    order = np.argsort(-lcp, kind="stable")
    xs, ys, ls = x[order].tolist(), y[order].tolist(), lcp[order].tolist()
    root: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    after: dict[int, int] = {}
    told: dict[int, int] = {}
    starts, distances, lcps, touched = [], [], [], []

    def find(a):
        while root.setdefault(a, a) != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    def close(level):
        for p in set(touched):
            if told.get(p) == after[p]:   # neighbours in the smaller set before
                continue
            told[p] = after[p]
            d = after[p] - p
            if d <= level:
                starts.append(p)
                distances.append(d)
                lcps.append(level)
        touched.clear()
    level = ls[0] if ls else 0
    for a, b, at in zip(xs, ys, ls, strict=True):
        if at != level:
            close(level)
            level = at
        a, b = find(a), find(b)
        large, small = members.setdefault(a, [a]), members.setdefault(b, [b])
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        for p in small:
            i = bisect_left(large, p)
            if i:
                after[large[i - 1]] = p
                touched.append(large[i - 1])
            if i < len(large):
                after[p] = large[i]
                touched.append(p)
            large.insert(i, p)
        root[b] = a
        del members[b]
    close(level)
    return starts, distances, lcps


def runs_of(texts: list[list[bytes]], min_words: int = MIN_WORDS, repeats: int = REPEATS) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of each text's runs by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + len(texts[to]) <= WORDS_AT_ONCE):
            total += len(texts[to])
            to += 1
        for doc, *run in _runs(texts[at:to], min_words, repeats):
            out[at + doc].append(tuple(run))
        at = to
    return out


def _runs(texts: list[list[bytes]], min_words: int, repeats: int) -> list[tuple[int, int, int, int]]:
    floor = least_lcp(min_words, repeats)
    width = 1 << floor.bit_length() - 1
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return []
    number: dict[bytes, int] = {}
    fresh = count()
    ids = np.array([number[w] if w in number else number.setdefault(w, next(fresh)) for t in texts for w in t], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(ids))
    hold = np.zeros(len(texts), bool)
    hold[doc[repeated(ids, doc, left, width)]] = True
    mine = hold[doc]
    ids, doc, left = ids[mine], doc[mine], left[mine]
    if not len(ids):
        return []
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    begin = np.zeros(len(texts), np.int64)
    begin[doc[first]] = first
    x, y, lcp = sorted_suffixes(ids, doc, left, width)
    enough = lcp >= floor
    s, q, c = (np.array(v, np.int64) for v in seeds(x[enough], y[enough], lcp[enough]))
    if not len(s):
        return []
    n = q + c
    before = np.maximum(s - 1, 0)
    extended = (s > begin[doc[s]]) & (ids[before] == ids[before + q])
    good = (n >= np.maximum(min_words, repeats * q)) & ~extended
    found = zip(doc[s[good]].tolist(), (s - begin[doc[s]])[good].tolist(), n[good].tolist(), q[good].tolist(), strict=True)
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """Greatest length / period; ties by start, then period."""
    return min(runs, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's repeats: one text in ten goes on with a part of itself.  A row without an id is left as it is."""
    n, h = len(words), 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS, repeats: int = REPEATS,
                  prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``docs`` with ``runs``, the ``best`` of them (null without one) and the collapsed words as ``text``.

    ``prepare`` changes a row's words, given its ``doc_id``, before they are looked at.
    """
    if repeats < 2 or min_words < 1:
        raise ValueError("repeats must be 2 or more, min_words 1 or more")
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN)])
    names = [f.name for f in RUN.fields]

    def make():
        def fn(cols):
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in cols[-1]]
            if prepare:
                words = [prepare(i, w) for i, w in zip(cols[0], words, strict=True)]
            found = runs_of(words, min_words, repeats)
            best = map(best_run, found)
            return {"text": [b" ".join(collapsed(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(words, found, strict=True)],
                    "runs": [[dict(zip(names, r, strict=True)) for r in rs] for rs in found],
                    "best": [b and dict(zip(names, b, strict=True)) for b in best]}
        return fn
    return map_texts(docs, ["doc_id", "text"] if prepare else ["text"], schema, make)


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    from tabsmith.llm.common import read
    done = collapse_runs(read(spark, sf_dir, "documents").select("doc_id", "text"), prepare=planted)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return done.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


ORACLE_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)),
split AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, crc_table),
sized AS (SELECT *, len(ws) AS n, h // 10 AS g FROM split),
parted AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM sized),
told AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM parted),
docs AS (
  SELECT doc_id, row, n, CASE WHEN h % 10 = 0 AND n > 0
      THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM told),
words AS (SELECT row, unnest(range(n)) AS i, unnest(ws) AS word FROM docs),
grams AS (
  SELECT row, i, word, CASE WHEN count(*) OVER w = 16 THEN md5(string_agg(word, ' ') OVER w) END AS gram
  FROM words WINDOW w AS (PARTITION BY row ORDER BY i ROWS BETWEEN CURRENT ROW AND 15 FOLLOWING)),
again AS (SELECT row, gram FROM grams WHERE gram IS NOT NULL GROUP BY row, gram HAVING count(*) > 1),
shared AS (SELECT g.row, g.i, g.gram FROM grams g SEMI JOIN again a ON g.row = a.row AND g.gram = a.gram),
pairs AS (SELECT x.row, x.i, y.i - x.i AS q FROM shared x JOIN shared y ON x.row = y.row AND x.gram = y.gram AND y.i > x.i),
stretches AS (
  SELECT row, q, min(i) AS s, q + count(*) + 15 AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs) GROUP BY row, q, island),
runs AS (
  SELECT * FROM stretches r WHERE len >= greatest(24, 3 * q)
  AND NOT EXISTS (SELECT 1 FROM stretches t WHERE t.row = r.row AND t.q < r.q AND t.s <= r.s AND t.s + t.len >= r.s + r.len)),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS body FROM words w
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.row = w.row AND w.i >= r.s + r.q AND w.i < r.s + r.len) GROUP BY row),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY row),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY len::DOUBLE / q DESC, s, q) = 1)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period,
       (1000 * b.len) // b.q AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.body, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON l.row = d.row LEFT JOIN best b ON b.row = d.row LEFT JOIN kept k ON k.row = d.row
"""
