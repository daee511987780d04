"""Exact substring deduplication with sharded suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts
anywhere else, in the same document or another; strings never cross documents.

Sharding by content.  Each string of ``LENGTH`` bytes is owned by its
minimizer: the leftmost ``ANCHOR``-byte window of smallest hash in it.  Equal
strings have equal minimizers, so all copies of a string meet under one anchor
hash, and only there.  A run of starts owned by one anchor, with the bytes that
its strings cover, is a context.

1. Every context is reduced to its anchor hash and a 128-bit digest; contexts
   that occur twice or more are repeated from end to end, whatever their number.
2. A context that occurs once, under an anchor hash that no other context has,
   holds no repeated string.
3. The distinct contexts of the remaining anchor hashes are dealt to shards.
   Each shard builds a suffix array (Larsson-Sadakane: order by 8 bytes, then
   double the order of the groups that are still unsorted), Kasai's common
   prefixes, and marks owned starts in runs of common prefixes of ``LENGTH``.
4. An anchor hash with more than ``HOT`` contexts is split over several shards.
   A shard then also gives one start of each of its distinct owned strings with
   the string's digest, unless the bytes around the anchor already differ from
   all other shards'; the shards' strings are merged in the order of their digests,
   and each is sought there by binary search.

Documents then lose all starts but those of contexts that stayed single.

Null text counts as empty.  Rows equal in id and text count as copies of each
other.  Texts under ``LENGTH`` bytes lose nothing.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import bounded_batches, map_texts, read, table

LENGTH = 400
ANCHOR = 48
#: Bytes whose anchors are computed at once (a longer text in overlapping pieces).
PIECE = 1 << 20
#: Bytes of contexts in a suffix array.
SHARD_BYTES = 1 << 19
#: Places that one lane of the common-prefix scan goes through.
LANE = 128
#: Starts of a cell, the unit in which shards of one anchor hash are compared before digests are given.
CELL = 32
#: Distinct contexts of an anchor hash in one shard.
HOT = 64
#: Strings of shards that one task merges.
MERGED = 1 << 15

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _powers(n: int, base: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled, power = 1, base & _MASK
    while filled < n:  # double what is known
        take = min(filled, n - filled)
        out[filled:filled + take] = out[:take] * np.uint64(power)
        filled += take
        power = power * power & _MASK
    return out


class Anchors:
    """Owned runs of starts of texts."""

    def __init__(self, length: int = LENGTH, width: int = ANCHOR):
        self.length, self.width = length, min(width, length)
        self.up = _powers(PIECE + length + 1, _ODD)
        self.down = _powers(PIECE + length + 1, pow(_ODD, -1, 1 << 64))

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of every window of ``width`` bytes."""
        n = len(data) - self.width + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=total[1:])
        h = (total[self.width:] - total[:-self.width]) * self.down[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h

    def runs(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last start, anchor place and anchor hash of every owned run; ``data`` is a piece of one text."""
        starts = len(data) - self.length + 1
        if starts <= 0:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        h = self.hashes(data)
        span = self.length - self.width + 1
        low = np.uint64(24)
        key = (h >> low << low) | np.arange(len(h), dtype=np.uint64)
        pad = -len(key) % span
        blocks = np.concatenate([key, np.full(pad, _MASK, np.uint64)]).reshape(-1, span)
        left = np.minimum.accumulate(blocks, axis=1).ravel()
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        best = np.minimum(right[:starts], left[span - 1:span - 1 + starts])
        place = (best & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        last = np.append(first[1:], starts) - 1
        return first, last, place[first], h[place[first]]

    def contexts(self, text: bytes) -> Iterator[tuple[int, int, int, bytes]]:
        """``(first start, last start, anchor's place, its hash, digest of offset and bytes)`` of every owned run."""
        data = np.frombuffer(text, np.uint8)
        for at in range(0, max(1, len(text) - self.length + 1), PIECE):
            piece = data[at:at + PIECE + self.length - 1]
            for lo, hi, place, h in zip(*(x.tolist() for x in self.runs(piece)), strict=True):
                body = text[at + lo:at + hi + self.length]
                yield at + lo, at + hi, at + place, h, hashlib.blake2b(body, digest_size=16, salt=(place - lo).to_bytes(8, "little")).digest()


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse and the 8 bytes at every place as big-endian numbers.  Ends sort as zero bytes, then by place."""
    n = len(data)
    wide = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    eight = np.zeros(n, np.uint64)
    for k in range(8):
        eight |= wide[k:n + k] << np.uint64(56 - 8 * k)
    sa = np.argsort(eight)
    ordered = eight[sa]
    new = np.append(True, ordered[1:] != ordered[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # first index of each group
    rank = np.empty(n, np.int32)
    rank[sa] = head
    todo = np.flatnonzero(~(new & np.append(new[1:], True)))  # indices of the array in groups of several
    h = 8
    while len(todo):
        at = sa[todo]
        to = at + h
        if to.max() < n:
            after = rank[to] + np.int64(h)
        else:  # past the end: below all others, and shorter is smaller
            after = np.where(to < n, rank[np.minimum(to, n - 1)] + np.int64(h), n - at - 1)
        key = rank[at].astype(np.uint64) << np.uint64(32) | after.astype(np.uint64)
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[todo] = at
        new = np.append(True, key[1:] != key[:-1])
        head = np.maximum.accumulate(np.where(new, todo, 0))
        rank[at] = head
        todo = todo[~(new & np.append(new[1:], True))]
        h *= 2
    return sa, rank, eight


def common_prefixes(sa: np.ndarray, rank: np.ndarray, eight: np.ndarray, most: int) -> np.ndarray:
    """Kasai: common prefix of every suffix with the one before it in order, up to ``most``, by place.

    Lanes of ``LANE`` places advance together; in a lane each step starts from
    the last prefix less one and compares eight bytes at a time.
    """
    n = len(sa)
    lanes = -(-n // LANE)
    out = np.zeros((lanes, LANE), np.int32)
    before = np.empty(n, np.int64)  # the suffix before, -1 for the first
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    padded = np.append(eight, np.zeros(most + 8, np.uint64))
    steps = np.array([np.uint64(1) << np.uint64(64 - 8 * k) for k in range(1, 8)], np.uint64)
    here = np.arange(lanes) * LANE
    length = np.zeros(lanes, np.int64)
    for t in range(LANE):
        if here[-1] >= n:
            here, length = here[:-1], length[:-1]
            if not len(here):
                break
        j = before[here]
        got = np.maximum(length - 1, 0)
        got[j < 0] = 0
        run = np.flatnonzero(j >= 0)
        while len(run):
            diff = padded[here[run] + got[run]] ^ padded[j[run] + got[run]]
            same = diff == 0
            part = run[~same]
            if len(part):
                got[part] += (diff[~same][:, None] < steps).sum(axis=1)
            run = run[same]
            got[run] += 8
            run = run[got[run] < most]
        length = np.minimum(got, n - np.maximum(here, j))
        out[:len(here), t] = length
        here = here + 1
    return np.minimum(out.ravel()[:n], most)


def repeated_starts(bodies: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all owned starts (places that have ``length`` bytes left in their body): body, offset, and group number.

    Starts of one group begin equal strings.
    """
    data = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    heads = np.cumsum(sizes) - sizes
    sa, rank, eight = suffix_array(data)
    lcp = common_prefixes(sa, rank, eight, length)
    group = np.cumsum(lcp[sa] < length)  # by order
    body = np.repeat(np.arange(len(bodies)), sizes)
    offset = np.arange(len(data)) - heads[body]
    owned = np.flatnonzero(offset + length <= sizes[body])
    return body[owned], offset[owned], group[rank[owned]]


# ---- Spark --------------------------------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, text, k1, k2)``; the key is a digest of id and text, the same in every scan."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    digest = F.md5(F.concat(name, F.lit("\n"), text).cast("binary"))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"),
                       *[F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(k) for at, k in ((1, "k1"), (17, "k2"))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) >= size:
            yield _batch(part, schema)
            part = []
    if part:
        yield _batch(part, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _contexts(keyed: DataFrame, length: int) -> DataFrame:
    """Distinct contexts: ``(h, c1, c2, n, k1, k2, lo, hi, anchor)`` with their number and one place."""
    schema = pa.schema([("h", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                        ("lo", pa.int32()), ("hi", pa.int32()), ("anchor", pa.int32())])

    def run(batches):
        anchors = Anchors(length)

        def rows():
            for r in _rows(batches):
                for lo, hi, anchor, h, c in anchors.contexts(r["text"].encode("utf-8", "surrogatepass")):
                    yield h - (1 << 64) if h >> 63 else h, *struct.unpack("<qq", c), r["k1"], r["k2"], lo, hi, anchor
        yield from _batches(rows(), schema, 8192)

    found = keyed.select("k1", "k2", "text").mapInArrow(run, "h long, c1 long, c2 long, k1 long, k2 long, lo int, hi int, anchor int")
    # any one place will do; all five values are those of the same row
    return found.groupBy("h", "c1", "c2").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("k1", "k2", "lo", "hi", "anchor")])


def _bodies(keyed: DataFrame, contexts: DataFrame, length: int, hot: int) -> DataFrame:
    """Bytes of the contexts whose anchor hash has others: ``(h, sub, parts, single, k1, k2, lo, anchor, body)``."""
    shared = table(contexts.groupBy("h").agg(F.count("*").alias("n_contexts")).where("n_contexts > 1"), "sa-shared")
    parts = F.ceil(F.col("n_contexts") / hot)
    wants = (contexts.join(shared, "h")
             .select("k1", "k2", F.struct("h", F.pmod(F.xxhash64("c1"), parts).cast("int").alias("sub"), parts.cast("int").alias("parts"),
                                     (F.col("n") == 1).alias("single"), "lo", "hi", "anchor").alias("want"))
             .groupBy("k1", "k2").agg(F.collect_list("want").alias("wants")))  # a text's own contexts
    out = pa.schema([("h", pa.int64()), ("sub", pa.int32()), ("parts", pa.int32()), ("single", pa.bool_()), ("k1", pa.int64()),
                     ("k2", pa.int64()), ("lo", pa.int32()), ("anchor", pa.int32()), ("body", pa.binary())])

    def run(batches):
        def rows():
            for r in _rows(batches):
                text = r["text"].encode("utf-8", "surrogatepass")
                for w in r["wants"]:
                    yield (w["h"], w["sub"], w["parts"], w["single"], r["k1"], r["k2"], w["lo"], w["anchor"], text[w["lo"]:w["hi"] + length])
        yield from _batches(rows(), out, 512)

    return (keyed.select("k1", "k2", "text").join(table(wants, "sa-wants"), ["k1", "k2"])
            .mapInArrow(run, "h long, sub int, parts int, single boolean, k1 long, k2 long, lo int, anchor int, body binary"))


def _shared_cells(split: DataFrame, length: int) -> DataFrame:
    """``(k1, k2, lo, cells)``: of the contexts of split anchors the cells whose core another shard has too.

    A cell holds the starts that lie ``CELL`` * k to ``CELL`` * (k + 1) - 1
    bytes before the anchor, its core the bytes that all their strings share.
    Equal strings lie in equal cells with equal cores, so a string whose core
    is in one shard only needs no digest.
    """
    out = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("h", pa.int64()), ("sub", pa.int32()),
                     ("cell", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])

    def run(batches):
        def rows():
            for r in _rows(batches):
                near, far = r["anchor"] - (r["lo"] + len(r["body"]) - length), r["anchor"] - r["lo"]
                for cell in range(near // CELL, far // CELL + 1):
                    core = r["anchor"] - CELL * cell - r["lo"]
                    yield (r["k1"], r["k2"], r["lo"], r["h"], r["sub"], cell,
                           *_digests(r["body"][max(core, 0):core - CELL + 1 + length]))
        yield from _batches(rows(), out, 8192)

    cells = table(split.mapInArrow(run, "k1 long, k2 long, lo int, h long, sub int, cell int, d1 long, d2 long"), "sa-cells")
    shared = cells.groupBy("h", "cell", "d1", "d2").agg(F.min("sub").alias("a"), F.max("sub").alias("b")).where("a < b").drop("a", "b")
    return (cells.join(table(shared, "sa-cores"), ["h", "cell", "d1", "d2"])
            .groupBy("k1", "k2", "lo").agg(F.collect_set("cell").alias("cells")))


def _digests(value: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(value, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _shard(rows: list[dict], length: int) -> Iterator[tuple]:
    """Of one shard: repeated runs of starts, and for split anchors one start of each distinct string."""
    body, offset, group = repeated_starts([r["body"] for r in rows], length)
    per_group = np.bincount(group)
    again = per_group[group] > 1
    single = np.array([r["single"] for r in rows])[body]
    # runs of repeated starts in contexts that occur once
    hits = np.flatnonzero(again & single)
    if len(hits):
        new = np.append(True, (body[hits][1:] != body[hits][:-1]) | (offset[hits][1:] != offset[hits][:-1] + 1))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(hits)) - 1
        for a, z in zip(hits[first].tolist(), hits[last].tolist(), strict=True):
            r = rows[body[a]]
            yield r["k1"], r["k2"], r["lo"] + int(offset[a]), r["lo"] + int(offset[z]), None, None, None, None, None
    # a start's cell is its distance before the anchor; only cells that other shards share are given
    ahead = np.array([r["anchor"] - r["lo"] for r in rows])[body] - offset
    wanted = {(i, c) for i, r in enumerate(rows) for c in r["cells"] or ()}
    one = np.flatnonzero(np.array([bool(r["cells"]) for r in rows])[body]) if wanted else np.zeros(0, np.int64)
    one = one[[(b, c) in wanted for b, c in zip(body[one].tolist(), (ahead[one] // CELL).tolist(), strict=True)]] if len(one) else one
    one = one[np.unique(group[one], return_index=True)[1]] if len(one) else one
    for k in one.tolist():
        r = rows[body[k]]
        at = int(offset[k])
        d1, d2 = _digests(r["body"][at:at + length])
        yield r["k1"], r["k2"], r["lo"] + at, r["lo"] + at, r["h"], r["sub"], d1, d2, bool(single[k] and not again[k])


def _search(bodies: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    kinds = "k1 long, k2 long, lo int, hi int, h long, sub int, d1 long, d2 long, open boolean"
    out = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("h", pa.int64()), ("sub", pa.int32()),
                     ("d1", pa.int64()), ("d2", pa.int64()), ("open", pa.bool_())])

    def run(batches):
        def rows():
            shard: list[dict] = []
            size, group = 0, None
            for r in _rows(batches):
                now = r["h"], r["sub"]
                if shard and now == group and all(r[c] == shard[-1][c] for c in ("k1", "k2", "lo")):
                    continue  # the same place of an equal row
                if shard and now != group and (size >= shard_bytes or now[0] == group[0]):
                    yield from _shard(shard, length)
                    shard, size = [], 0
                shard.append(r)
                size += len(r["body"])
                group = now
            if shard:
                yield from _shard(shard, length)
        yield from _batches(rows(), out, 8192)

    cells = table(_shared_cells(bodies.where("parts > 1"), length), "sa-shared-cells")
    bodies = bodies.join(cells, ["k1", "k2", "lo"], "left")
    return bodies.repartition("h", "sub").sortWithinPartitions("h", "sub", "k1", "k2", "lo").mapInArrow(run, kinds)


def _sought(part: pa.Table) -> np.ndarray:
    """Which of one bucket's strings are in another shard of their anchor, too.

    The shards' strings are merged in the order of (h, d1); every one is sought there by
    binary search, and a place of several is gone through for an equal second half.
    """
    h, d1, d2, shard = (part.column(c).to_numpy() for c in ("h", "d1", "d2", "sub"))
    key = h.astype(np.uint64) * np.uint64(_ODD) ^ d1.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    merged = key[order]
    first, last = np.searchsorted(merged, key, "left"), np.searchsorted(merged, key, "right")
    several = np.flatnonzero(last - first > 1)
    size = (last - first)[several]
    mine = np.repeat(several, size)
    other = order[np.repeat(first[several] - np.cumsum(size) + size, size) + np.arange(size.sum())]
    equal = (h[mine] == h[other]) & (d1[mine] == d1[other]) & (d2[mine] == d2[other]) & (shard[mine] != shard[other])
    hit = np.zeros(len(key), bool)
    hit[mine[equal]] = True
    return hit


def _merge(found: DataFrame) -> DataFrame:
    """Starts of split anchors whose string is in another shard too: ``(k1, k2, lo, hi)``."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())])

    def run(group: pa.Table) -> pa.Table:
        keep = pa.array(_sought(group) & group.column("open").to_numpy())
        return group.select(schema.names).filter(keep).cast(schema)
    given = found.where("d1 IS NOT NULL")
    # as many buckets as rows ask for; an anchor of any size is spread over them by its strings' digests
    buckets = max(1, -(-given.count() // MERGED))
    return given.groupBy(F.pmod("d1", F.lit(buckets)).alias("bucket")).applyInArrow(run, "k1 long, k2 long, lo int, hi int")


def _removed(n: int, marks: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal removed runs of a text of ``n`` bytes."""
    if n < length:
        return []
    gone = np.ones(n - length + 1, bool)
    for want in (False, True):  # contexts that occur once stay, but for what the shards found in them
        for m in marks or ():
            if m["found"] == want:
                gone[m["lo"]:m["hi"] + 1] = want
    edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
    out: list[tuple[int, int]] = []
    for s, e in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1 + length).tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], e
        else:
            out.append((s, e))
    return out


SPANS = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])


def _apply(docs: DataFrame, schema: T.StructType, fn, length: int, id_col: str, text_col: str, shard_bytes: int, hot: int) -> DataFrame:
    """``(doc_id, text)`` and the columns that ``fn(texts, spans)`` gives."""
    bounded_batches(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    contexts = table(_contexts(keyed, length), "sa-contexts")
    bodies = table(_bodies(keyed, contexts, length, hot), "sa-bodies")
    found = table(_search(bodies, length, shard_bytes), "sa-found")
    runs = found.where("d1 IS NULL").select("k1", "k2", "lo", "hi").unionByName(_merge(found))
    marks = (contexts.where("n = 1").select("k1", "k2", "lo", "hi", F.lit(False).alias("found"))
             .unionByName(runs.withColumn("found", F.lit(True)))
             .groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi", "found")).alias("marks")))  # a text's own contexts

    def task():
        def run(cols):
            spans = [_removed(len(t.encode("utf-8", "surrogatepass")), m, length) for t, m in zip(*cols, strict=True)]
            return fn(cols[0], spans)
        return run
    joined = keyed.join(table(marks, "sa-marks"), ["k1", "k2"], "left")
    return map_texts(joined, ["text", "marks"], schema, task).drop("k1", "k2", "marks")


def _kept(text: str, spans: list[tuple[int, int]]) -> bytes:
    data, at, out = text.encode("utf-8", "surrogatepass"), 0, []
    for s, e in spans:
        out.append(data[at:s])
        at = e
    return b"".join([*out, data[at:]])


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   shard_bytes: int = SHARD_BYTES, hot: int = HOT) -> DataFrame:
    """``(doc_id, text, spans)``: the byte ranges of every text that repeat, maximal and in order."""
    def fn(texts, spans):
        return {"spans": [[{"start": s, "end": e} for s, e in x] for x in spans]}
    return _apply(docs, SPANS, fn, length, id_col, text_col, shard_bytes, hot)


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` without the repeated bytes; a character that loses some of its bytes goes whole."""
    def fn(texts, spans):
        return {"text": [_kept(t, s).decode("utf-8", "ignore") for t, s in zip(texts, spans, strict=True)]}
    schema = T.StructType([T.StructField("text", T.StringType())])
    return _apply(docs, schema, fn, length, id_col, text_col, SHARD_BYTES, HOT).select("doc_id", "text")


DIGEST = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
                       T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType())])


def op10_suffix_array(spark, sf_dir: str) -> DataFrame:
    def fn(texts, spans):
        kept = [_kept(t, s) for t, s in zip(texts, spans, strict=True)]
        gone = [sum(e - s for s, e in x) for x in spans]
        return {"n_bytes": [len(k) + g for k, g in zip(kept, gone, strict=True)], "n_removed": gone,
                "n_spans": [len(x) for x in spans], "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept]}
    docs = read(spark, sf_dir, "documents")
    return _apply(docs, DIGEST, fn, LENGTH, "doc_id", "text", SHARD_BYTES, HOT).drop("text")
