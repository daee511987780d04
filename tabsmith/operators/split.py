"""Deterministic stratified splits and folds (L1-L4).

Exact per-class sizes come from a seeded random order, that of md5(seed||key).
A split needs the rows at two ranks of each class only: they are selected by
radix refinement of prefix counts, and every row is compared with them (one
join with a row per class).  Folds need every row's rank modulo k, which
``ranking.hashed_rank`` gives without a per-class window.

Per class with ``n`` rows: ``n_test = round(test*n)``,
``n_val = round(val*(n - n_test))``; ranks ``[0, n_test)`` are test, the
next ``n_val`` validation, the rest train.  sklearn balances rounding
across classes, so its per-class counts can differ from these by one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.scalars import col
from tabsmith.operators.ranking import hash_order, hashed_rank, non_null_keys
from tabsmith.session import materialize


#: Rows of a prefix bucket that may be put in order, and classes up to which their cuts are broadcast.
MOST_ROWS, BROADCAST_CLASSES = 1 << 17, 50_000
#: Hex digits of the hash that a pass counts by.
DIGITS = 4


def class_cuts(df: DataFrame, keys: list[str], key: str, seed: int | str, wanted, most_rows: int = MOST_ROWS) -> DataFrame:
    """``(keys, _n, _w0, _c0, _w1, _c1, ...)``: each class's size, wanted ranks and the row at each rank.

    ``wanted`` gives rank expressions over ``_n``; ``_c`` is the struct (hash, key) of the row
    of that rank in the order of hash and key, null where the rank is ``_n`` or more.  Selection
    by radix: counts by the first digits of the hash name the bucket of each rank, whose rows
    alone are counted by further digits while they are more than ``most_rows``, and then ranked.
    """
    rows = df.select(*keys, F.col(f"`{key}`").alias("_k"), hash_order(F.col(f"`{key}`"), seed).alias("_h"))
    digits = DIGITS
    counts = rows.groupBy(*keys, F.substring("_h", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_p")            # at most 16 ** DIGITS rows for each class
    counts = materialize(counts.withColumn("_first", F.sum("_c").over(w) - F.col("_c"))
                         .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys))))
    ranks = [r.cast("long") for r in wanted(F.col("_n"))]
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), r.alias("_r")) for i, r in enumerate(ranks)])).alias("_w")
    held = (F.col("_w._r") >= F.col("_first")) & (F.col("_w._r") < F.col("_first") + F.col("_c"))
    # one row for each class and rank: the bucket that holds it, and the rank inside
    open_ = materialize(counts.select(*keys, "_p", "_c", "_first", at).where(held)
                        .select(*keys, F.col("_w._i").alias("_i"), "_p", "_c", (F.col("_w._r") - F.col("_first")).alias("_r")))
    n, most = open_.agg(F.count(F.lit(1)), F.max("_c")).first()
    few = n <= BROADCAST_CLASSES

    def inside():
        buckets = open_.select(*keys, "_i", "_p", "_r")
        on = rows.withColumn("_p", F.substring("_h", 1, digits))
        return on.join(F.broadcast(buckets) if few else buckets, [*keys, "_p"])
    while most and most > most_rows and digits < 32:
        nxt = digits + DIGITS
        deeper = (inside().groupBy(*keys, "_i", "_r", F.substring("_h", 1, nxt).alias("_p")).agg(F.count(F.lit(1)).alias("_c")))
        v = Window.partitionBy(*keys, "_i").orderBy("_p")
        deeper = deeper.withColumn("_first", F.sum("_c").over(v) - F.col("_c"))
        open_ = materialize(deeper.where((F.col("_r") >= F.col("_first")) & (F.col("_r") < F.col("_first") + F.col("_c")))
                            .select(*keys, "_i", "_p", "_c", (F.col("_r") - F.col("_first")).alias("_r")))
        digits, most = nxt, open_.agg(F.max("_c")).first()[0]
    order = Window.partitionBy(*keys, "_i").orderBy("_h", "_k")
    found = inside().withColumn("_at", F.row_number().over(order) - 1).where("_at = _r")
    sizes = counts.groupBy(*keys).agg(F.first("_n").alias("_n"))
    cuts = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.struct("_h", "_k"))).alias(f"_c{i}") for i in range(len(ranks))])
    out = sizes.join(cuts, keys, "left")
    return materialize(out.select(*keys, "_n", *[r.alias(f"_w{i}") for i, r in enumerate(ranks)], *[f"_c{i}" for i in range(len(ranks))]))


def stratified_split(df: DataFrame, key: str, target: str, test: float = 0.1, val: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """L1 (and L2 with ``val=0``): adds ``split`` in {train, val, test}.

    No row is ranked: each class has at most two cuts in the hash order, and a row is
    compared with them.  Two narrow scans find the cuts (``class_cuts``).
    """
    base, keys = non_null_keys(df, [target])

    def wanted(n):
        n_test = F.round(F.lit(float(test)) * n)
        return [n_test, n_test + F.round(F.lit(float(val)) * (n - n_test))]
    cuts = class_cuts(base, keys, key, seed, wanted)
    few = cuts.count() <= BROADCAST_CLASSES
    j = base.join(F.broadcast(cuts) if few else cuts, keys)
    me = F.struct(hash_order(F.col(f"`{key}`"), seed).alias("_h"), F.col(f"`{key}`").alias("_k"))

    def below(i):   # a rank of _n has no row: all rows are below it
        return (F.col(f"_w{i}") > 0) & (F.col(f"_c{i}").isNull() | (me < F.col(f"_c{i}")))
    split = F.when(below(0), F.lit("test")).when(below(1), F.lit("val")).otherwise(F.lit("train"))
    return j.withColumn(out, split).select(*[F.col(f"`{c}`") for c in df.columns if c != out], out)


def kfold(df: DataFrame, key: str, target: str, k: int = 5, seed: int = 69, out: str = "fold") -> DataFrame:
    """L3: stratified fold id in [0, k): rank within class modulo k."""
    r = hashed_rank(df, [target], key, seed)
    return r.withColumn(out, F.pmod(F.col("_rank"), F.lit(k)).cast("int")).drop("_rank", "_group_n")


def head_sample(df: DataFrame, key: str, n: int = 100) -> DataFrame:
    """L4: first ``n`` rows by key (deterministic ``head``); a top-k, not a full sort."""
    return df.orderBy(col(key)).limit(n)


def split_frames(df: DataFrame, split_col: str = "split") -> dict[str, DataFrame]:
    """Views of one split-labelled frame; nothing is materialised."""
    return {s: df.where(col(split_col) == s) for s in ("train", "val", "test")}
