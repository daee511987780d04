"""Cosine near-duplicates of vectors by an epsilon grid order join.

Vectors are scaled to length one, so a cosine of at least ``t`` is a distance
of at most eps = sqrt(2 - 2 t).  They are projected on the leading principal
directions (fitted on a bounded sample; any orthonormal directions keep the
result right, since a projection never lengthens a distance), put in order of
their grid cells of width eps and cut into blocks, intervals of the order.

Two blocks meet only if their boxes in the projected space come within eps, and
their balls (centre and radius in the whole space), too: blocks are joined on the
grid cells of the first direction, then by box and ball.  Pairs of blocks go to
tasks in tiles of ``TILE`` x ``TILE`` blocks, so a block travels once for each tile of
its row and column and not for each partner.
Inside a task, two intervals are joined recursively: boxes farther apart than
eps end a branch, the longer interval is halved, and small ones are multiplied.
Two intervals so tight that all pairs must link (their balls' centres and radii
say so) are linked as a whole, so a large knot of near-equal vectors costs its
size and not its square.

A task gives one number of links for each vector and a forest of links that
connects what it found, never all pairs.  Equal vectors are one vector with a
weight.  Pairs within 1e-9 of the threshold are decided by the cosine of the
vectors as given, summed exactly (``math.fsum``).

Vectors that are null, empty, zero, or hold null or non-finite components, and
rows without an id, link with nothing and keep their own id as component;
vectors of different lengths do not link.  Rows that share an id are vectors of
their own with the id's component.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import components, read, table

THRESHOLD = 0.9
#: Bound of the sample that the principal directions are fitted on.
SAMPLE = 2048
#: Principal directions used for boxes, and for grid cells.
DIRECTIONS, GRID = 16, 8
#: Numbers of a block (its vectors times their length), and vectors of the smallest interval.
BLOCK_NUMBERS, LEAF = 4096 * 64, 256
#: Blocks along the side of a tile; fewer while there are not enough tiles for all tasks.
TILE, TILES = 8, 4


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(-1, dim)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by their largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def directions(sample: np.ndarray, k: int) -> np.ndarray:
    """Leading principal directions as columns."""
    centred = sample - sample.mean(axis=0)
    _, vecs = np.linalg.eigh(centred.T @ centred)
    return np.ascontiguousarray(vecs[:, ::-1][:, :k])


class Side:
    """A block: unit vectors, their projections and what is known of its intervals."""

    def __init__(self, raw: np.ndarray, weight: np.ndarray, basis: np.ndarray):
        self.raw, self.weight = raw, weight
        self.x = unit(raw)
        self.p = self.x @ basis
        self.known: dict[tuple[int, int], tuple] = {}

    def shape(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Box, centre and radius of an interval."""
        if (lo, hi) not in self.known:
            part = self.x[lo:hi]
            centre = part.mean(axis=0)
            radius = float(np.sqrt(((part - centre) ** 2).sum(axis=1).max()))
            self.known[lo, hi] = self.p[lo:hi].min(axis=0), self.p[lo:hi].max(axis=0), centre, radius
        return self.known[lo, hi]


class Links:
    """Weighted link counts and a union-find over the vectors of two blocks."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        r = self.root[x]
        while (self.root[r] != r).any():
            r = self.root[r]
        return r

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Connect the pairs; smaller numbers are roots."""
        while len(a):
            ra, rb = self.find(a), self.find(b)
            on = ra != rb
            a, b = a[on], b[on]
            np.minimum.at(self.root, np.maximum(ra, rb)[on], np.minimum(ra, rb)[on])


def join_blocks(left: Side, right: Side | None, threshold: float) -> Links:
    """All links between two blocks, or inside one (``right`` is None): the left's vectors come first."""
    eps = math.sqrt(2 - 2 * threshold)
    same = right is None
    other = left if same else right
    shift = 0 if same else len(left.x)
    out = Links(len(left.x) + (0 if same else len(other.x)))
    todo = [(0, len(left.x), 0, len(other.x))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        lo_a, hi_a, c_a, r_a = left.shape(a0, a1)
        lo_b, hi_b, c_b, r_b = other.shape(b0, b1)
        gap = np.maximum(0, np.maximum(lo_a - hi_b, lo_b - hi_a))
        apart = float(np.sqrt(((c_a - c_b) ** 2).sum()))
        if float((gap * gap).sum()) > (eps + 1e-7) ** 2 or apart - r_a - r_b > eps + 1e-7:
            continue
        diagonal = same and a0 == b0
        if apart + r_a + r_b < eps - 1e-7:  # all pairs link
            wa, wb = left.weight[a0:a1], other.weight[b0:b1]
            if diagonal:
                out.count[a0:a1] += wa.sum() - wa
            else:
                out.count[a0:a1] += wb.sum()
                out.count[shift + b0:shift + b1] += wa.sum()
            rest = np.concatenate([np.arange(a0, a1), np.arange(shift + b0, shift + b1)])
            out.join(np.full(len(rest), a0), rest)
            continue
        if max(a1 - a0, b1 - b0) > LEAF:
            if diagonal:
                m = (a0 + a1) // 2
                todo += [(a0, m, a0, m), (m, a1, m, a1), (a0, m, m, a1)]
            elif a1 - a0 >= b1 - b0:
                m = (a0 + a1) // 2
                todo += [(a0, m, b0, b1), (m, a1, b0, b1)]
            else:
                m = (b0 + b1) // 2
                todo += [(a0, a1, b0, m), (a0, a1, m, b1)]
            continue
        cos = left.x[a0:a1] @ other.x[b0:b1].T
        i, j = np.nonzero(cos >= threshold - 1e-9)
        if diagonal:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        near = np.flatnonzero(np.abs(cos[i, j] - threshold) <= 1e-9)
        if len(near):
            off = [k for k in near.tolist() if exact_cosine(left.raw[a0 + i[k]], other.raw[b0 + j[k]]) < threshold]
            i, j = np.delete(i, off), np.delete(j, off)
        i, j = i + a0, j + b0
        np.add.at(out.count, i, other.weight[j])
        np.add.at(out.count, shift + j, left.weight[i])
        out.join(i, shift + j)
    return out


def _valid(v):
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _blocks(groups: DataFrame, basis: np.ndarray, eps: float, block: int) -> DataFrame:
    """Blocks of the grid order, a row each; vectors are all as long as ``basis``."""
    dim, k = basis.shape
    grid = min(GRID, k)
    out_type = "rep long, weight long, raw binary, " + ", ".join(f"c{i} int" for i in range(grid)) + ", first double"

    def place(batches):
        for batch in batches:
            raw = np.array(batch.column(batch.schema.get_field_index("v")).to_pylist(), "<f8")
            p = unit(raw) @ basis[:, :grid]
            cells = np.floor(p / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("rep")), batch.column(batch.schema.get_field_index("weight")),
                 pa.array([r.tobytes() for r in raw], pa.binary()), *(pa.array(cells[:, i]) for i in range(grid)),
                 pa.array(p[:, 0])], names=["rep", "weight", "raw", *(f"c{i}" for i in range(grid)), "first"])

    placed = groups.select("rep", "weight", "v").mapInArrow(place, out_type)
    order = [*(f"c{i}" for i in range(grid)), "first", "rep"]
    ranged = pa.schema([("part", pa.int32()), ("idx", pa.int64()), ("rep", pa.int64()), ("weight", pa.int64()), ("raw", pa.binary())])

    def number(batches):
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("rep", "weight", "raw")]
            yield pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), *cols],
                                             schema=ranged)
            at += n

    rows = table(placed.repartitionByRange(*order).sortWithinPartitions(*order).select("rep", "weight", "raw")
                 .mapInArrow(number, "part int, idx long, rep long, weight long, raw binary"), "ego-order")
    # a block is an interval of the whole order, however the ranges fell: one offset for each range
    offsets, total = [], 0
    for part, n in sorted(rows.groupBy("part").count().collect()):
        offsets.append((part, total))
        total += n
    place_of = groups.sparkSession.createDataFrame(offsets, "part int, offset long")
    schema = pa.schema([("id", pa.int64()), ("reps", pa.binary()), ("weights", pa.binary()), ("raw", pa.binary()),
                        ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("centre", pa.list_(pa.float64())), ("radius", pa.float64())])

    def cut(batches):
        def emit(held):
            raw = b"".join(r["raw"] for r in held)
            x = unit(_matrix(raw, dim))
            p, centre = x @ basis, x.mean(axis=0)
            cols = (held[0]["pos"] // block, np.array([r["rep"] for r in held], "<i8").tobytes(),
                    np.array([r["weight"] for r in held], "<i8").tobytes(), raw, p.min(axis=0), p.max(axis=0),
                    centre, float(np.sqrt(((x - centre) ** 2).sum(axis=1).max())))
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cols, schema.types, strict=True)], schema=schema)
        held: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if held and r["pos"] // block != held[0]["pos"] // block:
                    yield emit(held)
                    held = []
                held.append(r)
        if held:
            yield emit(held)

    return (rows.join(F.broadcast(place_of), "part").withColumn("pos", F.col("offset") + F.col("idx"))
            .withColumn("block", F.expr(f"pos div {int(block)}")).select("block", "pos", "rep", "weight", "raw")
            .repartition("block").sortWithinPartitions("block", "pos")
            .mapInArrow(cut, "id long, reps binary, weights binary, raw binary, lo array<double>, hi array<double>, centre array<double>, radius double"))


def _pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Ids ``(a, b)``, a <= b, of blocks whose boxes and balls come within eps."""
    def cell(x):
        return F.floor(x / eps).cast("int")
    box = blocks.select("id", "lo", "hi", "centre", "radius")
    a = box.select(F.col("id").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), F.col("centre").alias("ac"), F.col("radius").alias("ar"),
                   F.explode(F.sequence(cell(F.element_at("lo", 1)) - 1, cell(F.element_at("hi", 1)) + 1)).alias("cell"))
    b = box.select(F.col("id").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.col("centre").alias("bc"), F.col("radius").alias("br"),
                   F.explode(F.sequence(cell(F.element_at("lo", 1)), cell(F.element_at("hi", 1)))).alias("cell"))
    gap = F.zip_with(F.zip_with("alo", "bhi", lambda x, y: x - y), F.zip_with("blo", "ahi", lambda x, y: x - y),
                     lambda x, y: F.greatest(x, y, F.lit(0.0)))
    far = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    apart = F.sqrt(F.aggregate(F.zip_with("ac", "bc", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    met = a.join(b, "cell").where((F.col("a") <= F.col("b")) & (far <= (eps + 1e-7) ** 2))
    return met.where(apart - F.col("ar") - F.col("br") <= eps + 1e-7).select("a", "b").distinct()


def _join(blocks: DataFrame, pairs: DataFrame, basis: np.ndarray, threshold: float) -> DataFrame:
    """``(rep, links, root)``: of every block pair the vectors that link, their links in it and the end of a forest edge."""
    dim = basis.shape[0]
    count = blocks.count()
    side_blocks = max(1, min(TILE, count // TILES))
    tiled = pairs.select(F.expr(f"a div {side_blocks}").alias("ta"), F.expr(f"b div {side_blocks}").alias("tb"), "a", "b")
    lists = tiled.groupBy("ta", "tb").agg(F.collect_list(F.struct("a", "b")).alias("pairs"))      # at most TILE * TILE pairs
    wanted = tiled.select("ta", "tb", F.explode(F.array("a", "b")).alias("id")).distinct()
    bodies = wanted.join(blocks.select("id", "reps", "weights", "raw"), "id").unionByName(lists, allowMissingColumns=True)
    # the bodies of a tile come before its list of pairs
    dealt = bodies.repartition("ta", "tb").sortWithinPartitions("ta", "tb", F.col("pairs").isNotNull())
    schema = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def side(x):
        return Side(_matrix(x["raw"], dim), np.frombuffer(x["weights"], "<i8"), basis)

    def run(batches):
        held: dict[int, tuple[np.ndarray, Side]] = {}
        for batch in batches:
            cols = {n: batch.column(batch.schema.get_field_index(n)) for n in ("id", "reps", "weights", "raw", "pairs")}
            for k in range(batch.num_rows):
                r = {n: c[k].as_py() for n, c in cols.items()}
                if r["pairs"] is None:
                    held[r["id"]] = np.frombuffer(r["reps"], "<i8"), side(r)
                    continue
                for p in r["pairs"]:
                    (ids, left), (more, right) = held[p["a"]], held[p["b"]]
                    same = p["a"] == p["b"]
                    found = join_blocks(left, None if same else right, threshold)
                    if not same:
                        ids = np.concatenate([ids, more])
                    some = np.flatnonzero(found.count)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(found.count[some]), pa.array(ids[found.find(some)])], schema=schema)
                held = {}

    return dealt.select("id", "reps", "weights", "raw", "pairs").mapInArrow(run, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding",
                    block: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, a row per row of ``vectors``; ``block``: vectors of a block."""
    spark = vectors.sparkSession
    eps = math.sqrt(2 - 2 * threshold)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("valid", _valid(F.col("v")) & F.col("vec_id").isNotNull())
    rows = rows.withColumn("v", F.when(F.col("valid"), F.transform("v", lambda x: x + 0.0)))  # -0.0 equals 0.0
    groups = table(rows.where("valid").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")), "ego-groups")
    links = None
    for (dim,) in groups.select(F.size("v")).distinct().orderBy(F.size("v")).toLocalIterator():
        mine = groups.where(F.size("v") == dim)
        picked = mine.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("v").collect()
        basis = directions(unit(np.array([r[0] for r in picked])), min(DIRECTIONS, dim))
        blocks = table(_blocks(mine, basis, eps, block or max(LEAF, BLOCK_NUMBERS // dim)), "ego-blocks")
        got = _join(blocks, table(_pairs(blocks, eps), "ego-pairs"), basis, threshold)
        links = got if links is None else links.unionByName(got)
    if links is None:
        links = spark.createDataFrame([], "rep long, links long, root long")
    links = table(links, "ego-links")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    found = components(links.selectExpr("rep AS a", "root AS b"), "ego-cc")
    of = table(groups.join(counts, "rep", "left").join(found, groups.rep == found.node, "left")
               .select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")), "ego-of")
    done = rows.join(of, "v", "left")
    return done.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       F.coalesce("component_id", "vec_id").alias("component_id"),
                       F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))


def op5_ego_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))
