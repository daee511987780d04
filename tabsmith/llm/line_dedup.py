"""Line deduplication over a sharded minimal perfect hash.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased.  Keys of ``min_chars`` code points or more that are found in two
documents or more lose all their lines but those of the smallest ``doc_id``
that holds them.

1. Every document gives the 128-bit digests of its distinct keys; an aggregate
   counts the documents of each digest and takes the smallest and largest id.
2. The digests of two documents or more are dealt to shards by one half of the
   digest.  A shard is built alone, as a minimal perfect hash: levels of bits,
   where a digest that is alone at its place of a level takes that bit and the
   others go on to the next; the number of set bits before a digest's bit is its
   place in dense arrays of fingerprint (the other half of the digest), count and
   keeper.  Every shard is one row of binary columns, of bounded size.
3. Documents probe the arrays and are not joined with lines.  While all shards
   together are within ``BROADCAST_BYTES`` every task holds them.  Beyond, the
   distinct (document, digest) pairs are sent to their shard, in ``SALTS`` parts,
   a streaming task probes them, and only lines to drop come back.

Defined results: a null or empty text is one empty line; rows of equal
``doc_id`` are one document; rows without an id are together one document that
comes after all others; an empty table gives an empty result.  Columns of the
input stay; ``text``, ``n_lines`` and ``n_dropped`` (in any case) are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import bounded_batches, map_texts, table

MIN_CHARS = 10
SPACE = " \t\n\v\f\r"
#: Digests of a shard, on average; a shard takes about 25 bytes for each.
SHARD_KEYS = 1 << 14
#: Bound of a broadcast of all shards.
BROADCAST_BYTES = 16 << 20
#: Parts of a shard's probes where shards are not broadcast, so that a line of very many documents is spread.
SALTS = 16
#: Places of a level for each digest left at it.
ROOM = 1.6
#: Stands for a missing doc_id: after all others.
NO_ID = (1 << 63) - 1


def digests(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The 16-byte digest of each line's key, None for keys under ``min_chars`` code points."""
    out = []
    for line in (text or "").split("\n"):
        key = line.strip(SPACE)
        out.append(blake2b(key.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest()
                   if len(key) >= min_chars else None)
    return out


def _halves(found: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)


# -- the minimal perfect hash ---------------------------------------------------------

def _places(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of every digest in a level of ``size`` bits."""
    x = hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ lo.astype(np.uint64) + np.uint64(level)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return ((x ^ x >> np.uint64(31)) % np.uint64(size)).astype(np.int64)


def _before(words: np.ndarray) -> np.ndarray:
    """Set bits before each word."""
    return np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.int32)


def build_hash(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(sizes, words)`` of the levels for distinct digests; sizes are multiples of 64 bits."""
    sizes, words = [], []
    while len(hi):
        size = 64 * max(1, -(-int(len(hi) * ROOM) // 64))
        at = _places(hi, lo, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = ~alone[at]
        hi, lo = hi[left], lo[left]
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64)


def find(sizes: np.ndarray, words: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Dense place of each digest, below the number of digests; -1 or any place for strangers."""
    before, out = _before(words), np.full(len(hi), -1, np.int64)
    left, first = np.arange(len(hi)), 0
    for level, size in enumerate(sizes.tolist()):
        if not len(left):
            break
        at = _places(hi[left], lo[left], level, size) + 64 * first
        word, bit = words[at >> 6], (at & 63).astype(np.uint64)
        here = (word >> bit & np.uint64(1)).astype(bool)
        rank = before[at >> 6] + np.bitwise_count(word & (np.uint64(1) << bit) - np.uint64(1))
        out[left[here]] = rank[here]
        left, first = left[~here], first + size // 64
    return out


def build_shard(hi: np.ndarray, lo: np.ndarray, n: np.ndarray, keeper: np.ndarray) -> dict[str, bytes]:
    """The arrays of one shard as bytes."""
    sizes, words = build_hash(hi, lo)
    place = find(sizes, words, hi, lo)
    prints, counts, keepers = np.zeros(len(hi), "<i8"), np.zeros(len(hi), "<u4"), np.zeros(len(hi), "<i8")
    prints[place], counts[place], keepers[place] = lo, np.minimum(n, 0xFFFFFFFF), keeper
    return {"sizes": sizes.astype("<i8").tobytes(), "words": words.astype("<u8").tobytes(), "prints": prints.tobytes(),
            "counts": counts.tobytes(), "keepers": keepers.tobytes()}


ARRAYS = {"sizes": "<i8", "words": "<u8", "prints": "<i8", "counts": "<u4", "keepers": "<i8"}


def probe(shard: dict[str, bytes] | None, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(count, keeper)`` of each digest; count 0 for digests that the shard does not hold."""
    count, keeper = np.zeros(len(hi), np.int64), np.zeros(len(hi), np.int64)
    if shard is None or not len(shard["prints"]):
        return count, keeper
    a = {k: np.frombuffer(shard[k], t) for k, t in ARRAYS.items()}
    place = find(a["sizes"], a["words"], hi, lo)
    own = place >= 0
    own[own] = a["prints"][place[own]] == lo[own]
    count[own], keeper[own] = a["counts"][place[own]], a["keepers"][place[own]]
    return count, keeper


# -- Spark ----------------------------------------------------------------------------

def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(hi, lo, n, keeper)``: digests of two documents or more, the rows of documents that hold them, the smallest id."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, owner = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = set(digests(text, min_chars))
                own.discard(None)
                found += own
                owner += [NO_ID if i is None else i] * len(own)
            keys = _halves(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(owner, pa.int64())],
                                             names=["hi", "lo", "doc"])
    each = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "hi long, lo long, doc long")
    return (each.groupBy("hi", "lo").agg(F.count("*").alias("n"), F.min("doc").alias("keeper"), F.max("doc").alias("last"))
            .where("keeper != last").drop("last"))


def build_index(keys: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """``(shard, sizes, words, prints, counts, keepers)``, a row per shard, and the number of shards."""
    keys = table(keys, "line-keys")
    shards = max(1, -(-keys.count() // shard_keys))

    def build(group: pa.Table) -> pa.Table:
        hi, lo, n, keeper, shard = (group.column(c).to_numpy() for c in ("hi", "lo", "n", "keeper", "shard"))
        made = build_shard(hi, lo, n, keeper)
        return pa.table({"shard": pa.array([int(shard[0])], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in made.items()}})
    schema = "shard int, " + ", ".join(f"{k} binary" for k in ARRAYS)
    dealt = keys.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int"))
    return table(dealt.groupBy("shard").applyInArrow(build, schema), "line-index"), shards


def _sent_probes(docs: DataFrame, index: DataFrame, shards: int, min_chars: int) -> DataFrame:
    """``(doc, gone)``: the digests whose lines each document loses, found at the shards."""
    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, owner = [], []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = set(digests(text, min_chars))
                own.discard(None)
                found += own
                owner += [NO_ID if i is None else i] * len(own)
            keys = _halves(found)
            yield pa.RecordBatch.from_arrays([pa.array((keys[:, 0] % shards).astype(np.int32)), pa.array(owner, pa.int64()),
                                              pa.array(keys[:, 0]), pa.array(keys[:, 1])], names=["shard", "doc", "hi", "lo"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, arrays = None, None
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            shard, doc, hi, lo = (cols[c].fill_null(0).to_numpy() for c in ("shard", "doc", "hi", "lo"))
            first = cols["prints"].is_valid().to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(first | np.concatenate([[True], shard[1:] != shard[:-1]]))
            for s, e in zip(starts, [*starts[1:], len(shard)], strict=True):
                if first[s]:
                    held, arrays, s = shard[s], {k: cols[k][int(s)].as_py() for k in ARRAYS}, s + 1
                if s < e:
                    count, keeper = probe(arrays if held == shard[s] else None, hi[s:e], lo[s:e])
                    gone = np.flatnonzero((count > 0) & (keeper != doc[s:e])) + s
                    yield pa.RecordBatch.from_arrays([pa.array(doc[gone]), pa.array(
                        [x.tobytes() for x in np.stack([hi[gone], lo[gone]], 1).astype("<i8")], pa.binary())], names=["doc", "key"])
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")
    probes = (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(give, "shard int, doc long, hi long, lo long")
              .distinct().withColumn("salt", salt))
    parts = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = parts.unionByName(probes, allowMissingColumns=True)
    dealt = both.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("prints").isNull())
    return (dealt.mapInArrow(answer, "doc long, key binary")
            .groupBy(F.col("doc").alias("__doc")).agg(F.collect_list("key").alias("__gone")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, broadcast_bytes: int = BROADCAST_BYTES,
                shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` with the kept lines as ``text``, ``n_lines`` (before) and ``n_dropped``."""
    spark = docs.sparkSession
    index, shards = build_index(line_keys(docs, min_chars), shard_keys)
    size = index.agg(F.sum(sum(F.octet_length(k) for k in ARRAYS))).first()[0] or 0
    out = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()),
                        T.StructField("n_dropped", T.LongType())])

    def keep(text, lost):
        lines = (text or "").split("\n")
        return "\n".join(x for x, gone in zip(lines, lost, strict=True) if not gone), len(lines), sum(lost)

    if size <= broadcast_bytes:
        held = spark.sparkContext.broadcast({r["shard"]: {k: bytes(r[k]) for k in ARRAYS} for r in index.collect()})

        def make():
            def fn(cols):
                per = [digests(t, min_chars) for t in cols[1]]
                keys = _halves([d for own in per for d in own if d])
                owner = np.repeat(np.array([NO_ID if i is None else i for i in cols[0]], np.int64),
                                  [sum(d is not None for d in own) for own in per])
                shard = keys[:, 0] % shards
                gone = np.zeros(len(keys), bool)
                order = np.argsort(shard, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
                    if len(part):
                        count, keeper = probe(held.value.get(int(shard[part[0]])), keys[part, 0], keys[part, 1])
                        gone[part] = (count > 0) & (keeper != owner[part])
                verdict = iter(gone.tolist())
                done = [keep(t, [d is not None and next(verdict) for d in own]) for t, own in zip(cols[1], per, strict=True)]
                return {n: [d[i] for d in done] for i, n in enumerate(out.names)}
            return fn
        return map_texts(docs, ["doc_id", "text"], out, make)

    lost = table(_sent_probes(docs, index, shards, min_chars), "line-gone")
    taken = {c.lower() for c in docs.columns}
    doc, gone = (next(n for n in (f"{base}{i}" for i in range(len(taken) + 1)) if n not in taken) for base in ("lost_doc", "lost_keys"))
    lost = lost.toDF(doc, gone)
    joined = docs.join(lost, F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)) == lost[doc], "left").drop(doc)

    def make():
        def fn(cols):
            done = []
            for text, mine in zip(cols[0], cols[1], strict=True):
                mine = set(mine or ())
                done.append(keep(text, [d is not None and d in mine for d in digests(text, min_chars)]))
            return {n: [d[i] for d in done] for i, n in enumerate(out.names)}
        return fn
    return map_texts(joined, ["text", gone], out, make).drop(gone)


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    from tabsmith.llm.common import read
    done = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, row, i, ls[i] AS line,
         translate(regexp_replace(regexp_replace(ls[i], '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, row, ls, unnest(generate_series(1, len(ls))) AS i
        FROM (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
shared AS (
  SELECT key, min(doc_id) AS keeper FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.doc_id, l.row, l.i, l.line, s.key IS NOT NULL AND s.keeper != l.doc_id AS gone
  FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id, row
"""
