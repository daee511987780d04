"""SimHash near-duplicates with covering locality-sensitive hashing.

Fingerprint: lower-case A-Z, words are runs without ASCII white space,
shingles of ``shingle`` words joined by a space (repeats count; a shorter
text is one shingle, a text without words has fingerprint zero).  Each
shingle's XXH64 (UTF-8, seed 42) votes on 64 bits; a bit is set if it is set
in over half of the hashes.

Linking: every bit position gets a non-zero vector of F2^(r+1); the mask of
each of the 2^(r+1) - 1 non-zero vectors v keeps the positions whose vector
has an odd inner product with v.  Any r positions span at most an
r-dimensional space, so some v is orthogonal to all of them: two fingerprints
that differ in r bits or fewer agree under that mask and meet in its table.

Inside a table's bucket no pairs are listed: a member is sent to the
fingerprints within r // 2 flips of the positions that the mask drops (for
odd r to one flip more), where all within the radius meet.  So few members
can meet at one such point that they are linked in a star after a check of the
distance.

Null text counts as empty, rows with equal ``doc_id`` as one document, and a
null ``doc_id`` gets the component of its fingerprint's other documents.  An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import components, free_name, map_texts, table

SHINGLE = 3
RADIUS = 2
#: Shingles whose bits are counted at once; bounds memory on very long texts.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        hashes = np.array([xxh64_intdigest(joined[s:e], 42) for s, e in zip(starts, stops, strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row."""
    def make():
        return lambda cols: {"fp": [fingerprint(t, shingle) for t in cols[0]]}
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(narrow, ["text"], T.StructType([T.StructField("fp", T.LongType())]), make).select("doc_id", "fp")


def covering_masks(radius: int = RADIUS) -> list[int]:
    """Masks of 64 bits; any two words within ``radius`` bits agree under one of them."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(64) if ((i % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(mask: int, radius: int) -> list[int]:
    """Words of up to ceil(radius / 2) bits among those that the mask drops."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [_signed(sum(1 << i for i in c)) for k in range((radius + 1) // 2 + 1) for c in combinations(free, k)]


def _by_table(values: list, kind: str, v: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) if kind == "long" else F.array(*map(F.lit, x)) for x in values]), v)


def links(groups: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` between representatives whose fingerprints link.

    ``groups`` has a row ``(fp, rep)`` for each distinct fingerprint.  The
    edges connect all fingerprints within ``radius`` bits and no others,
    though not each pair has its own edge.
    """
    masks = covering_masks(radius)
    v = F.explode(F.sequence(F.lit(1), F.lit(len(masks)))).alias("v")
    keyed = (groups.select("fp", "rep", v)
             .select("v", F.col("fp").bitwiseAND(_by_table([_signed(m) for m in masks], "long", F.col("v"))).alias("key"),
                     "fp", "rep"))
    shared = table(keyed.groupBy("v", "key").count().where("count > 1").select("v", "key"), "simhash-buckets")
    near = (keyed.join(shared, ["v", "key"])
            .select("fp", "rep", F.explode(_by_table([_flips(m, radius) for m in masks], "array", F.col("v"))).alias("flip"))
            .select(F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), F.struct("fp", "rep").alias("one")))
    stars = near.groupBy("point").agg(F.collect_set("one").alias("all")).where(F.size("all") > 1)
    if radius % 2 == 0:  # all that meet are within the radius
        pairs = stars.select(F.array_min("all").alias("x"), F.explode("all").alias("y"))
    else:
        pairs = stars.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y"))
    far = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
    return pairs.where((F.col("x.fp") != F.col("y.fp")) & (far <= radius)).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).where("a != b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)``: a row per row of ``docs``."""
    fps = table(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    groups = table(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-groups")
    found = components(links(groups, radius), "simhash-cc")
    of = table(groups.join(found, groups.rep == found.node, "left")
               .select("fp", F.coalesce("component", "rep").alias("component_id")), "simhash-of")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is the smallest of its component; rows without an id stay."""
    name = free_name(docs.columns, "gone")
    gone = near_duplicates(docs, shingle, radius).where("doc_id != component_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    from tabsmith.llm.common import read
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
