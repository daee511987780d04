"""Exact quantiles by sketch, count and a sort of the bracketed rows alone.

1. A mergeable rank sketch of each group (``percentile_approx``: Greenwald-Khanna
   summaries, partial aggregates) brackets every wanted rank: of n rows about
   4 n / ``ACCURACY`` lie inside.
2. While brackets hold more than ``MOST_ROWS`` rows a narrowing scan counts the rows of
   every cell (before, inside and between brackets) and sketches the inside ones, so
   a bracket shrinks by some ``GRID`` / 3 with each scan.
3. One counting scan: rows outside all brackets only add to their cell's count, rows
   inside count by value.  What is shuffled, and sorted, is these values alone, whatever
   the size of the column; running counts over cells and values give every rank.

The counts prove the result: a rank that falls outside its bracket (a sketch that was
off, numbers beyond 2^53) is found from the whole group by ``ranking.exact_quantiles``, which sorts it in ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.operators import ranking
from tabsmith.operators.ranking import non_null_keys
from tabsmith.session import materialize

#: Rank error of a sketch is n / ACCURACY.
ACCURACY = 2_000
#: Rows that a bracket may hold when its values are sorted.
MOST_ROWS = 1 << 19
#: Cuts of a bracket by a narrowing scan.
GRID = 1000
#: Brackets are broadcast up to so many groups (a row of some 20 numbers each).
BROADCAST_GROUPS = 50_000


def _wanted(probs: list[float]) -> list[tuple]:
    """Lower rank, upper rank and position of each probability, of a group of ``_n`` rows."""
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    return [(F.floor(a), F.ceil(a), a) for a in at]


def _cell(value, probs: list[float]):
    """0 before the first bracket, 1 inside it, 2 between it and the second, ..."""
    v = F.col(value)
    cell = F.when(v < F.col("_lo0"), 0).when(v <= F.col("_hi0"), 1)
    for i in range(1, len(probs)):
        cell = cell.when(v < F.col(f"_lo{i}"), 2 * i).when(v <= F.col(f"_hi{i}"), 2 * i + 1)
    return cell.otherwise(2 * len(probs))


def _with_brackets(d: DataFrame, brackets: DataFrame, gk: list[str], few: bool, probs: list[float]) -> DataFrame:
    bounds = brackets.select(*gk, *[f"_{s}{i}" for i in range(len(probs)) for s in ("lo", "hi")])
    return d.join(F.broadcast(bounds) if few else bounds, gk)


def exact_quantiles(long_df: DataFrame, group_cols: list[str], value_col: str, probs: list[float], names: list[str] | None = None,
                    accuracy: int = ACCURACY, most_rows: int = MOST_ROWS, grid: int = GRID) -> DataFrame:
    """Exact quantiles with linear interpolation (the pandas/numpy default).

    Nulls are ignored; a group without values has no row (without groups: one row of nulls).
    """
    names = names or [f"q{int(round(p * 100))}" for p in probs]
    if not group_cols:
        one = exact_quantiles(long_df.withColumn("_g", F.lit(0)), ["_g"], value_col, probs, names, accuracy, most_rows, grid)
        return one.agg(*[F.max(n).alias(n) for n in names])
    order = sorted(range(len(probs)), key=lambda i: probs[i])
    ps = [probs[i] for i in order]
    base, gk = non_null_keys(long_df.where(F.col(value_col).isNotNull()), list(group_cols))
    carried = [g for g in group_cols if g not in gk]
    d = base.select(*gk, *carried, value_col)

    sides = sorted({min(1.0, max(0.0, p + s * 2.0 / accuracy)) for p in ps for s in (-1, 1)})
    place = {p: i for i, p in enumerate(sides)}
    sketch = d.groupBy(*gk, *carried).agg(F.count(F.lit(1)).alias("_n"), F.min(value_col).alias("_mn"), F.max(value_col).alias("_mx"),
                                          F.percentile_approx(value_col, sides, accuracy).alias("_s"))

    def side(p, s):
        at = min(1.0, max(0.0, p + s * 2.0 / accuracy))
        edge = F.col("_mn") if at == 0.0 else F.col("_mx") if at == 1.0 else F.col("_s")[place[at]]
        # a small group is one bracket: the sketch's error would be under a rank
        return F.when(F.col("_n") <= 2 * accuracy, F.col("_mn") if s < 0 else F.col("_mx")).otherwise(edge)
    bounds = [side(p, s).alias(f"_{n}{i}") for i, p in enumerate(ps) for s, n in ((-1, "lo"), (1, "hi"))]
    brackets = materialize(sketch.select(*gk, *carried, "_n", "_mn", "_mx", *bounds))
    groups, largest = brackets.agg(F.count(F.lit(1)), F.max("_n")).first()
    few = groups <= BROADCAST_GROUPS
    inside = (largest or 0) * 6 // accuracy
    while inside > most_rows:
        brackets, inside = _narrowed(d, brackets, gk, carried, value_col, ps, few, accuracy, grid)

    cell = _cell(value_col, ps)
    counted = (_with_brackets(d, brackets, gk, few, ps)
               .select(*gk, cell.alias("_cell"), F.when(cell % 2 == 1, F.col(value_col)).alias("_v"))
               .groupBy(*gk, "_cell", "_v").agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*gk).orderBy("_cell", "_v")    # the values inside the group's brackets, a row for each other cell
    run = counted.withColumn("_last", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sizes = brackets.select(*gk, *carried, "_n")
    run = run.join(F.broadcast(sizes) if few else sizes, gk)
    first = F.col("_last") - F.col("_c")

    def at(r):
        return F.max(F.when((first <= r) & (r < F.col("_last")), F.col("_v")))
    aggs = []
    for i, (lo, hi, pos) in enumerate(_wanted(ps)):
        aggs += [at(lo).alias(f"_a{i}"), at(hi).alias(f"_b{i}"), F.max(pos - lo).alias(f"_f{i}")]
    got = run.groupBy(*gk, *carried).agg(*aggs)
    value = {order[i]: F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}") for i in range(len(ps))}
    lost = reduce(lambda x, y: x | y, [F.col(f"_{s}{i}").isNull() for i in range(len(ps)) for s in "ab"])
    got = materialize(got.select(*gk, *carried, lost.alias("_lost"), *[value[i].alias(n) for i, n in enumerate(names)]))
    found = got.where("NOT _lost").select(*group_cols, *names)
    missed = got.where("_lost").select(*gk)
    if missed.isEmpty():
        return found
    again = ranking.exact_quantiles(base.join(missed, gk, "left_semi"), list(group_cols), value_col, probs, names)
    return found.unionByName(again.select(*group_cols, *names))


def _narrowed(d: DataFrame, brackets: DataFrame, gk: list[str], carried: list[str], value_col: str, ps: list[float], few: bool,
              accuracy: int, grid: int) -> tuple[DataFrame, int]:
    """Brackets cut by the counts and sketches of the rows inside them, and the most rows that one can hold."""
    cell = _cell(value_col, ps)
    cuts = [i / grid for i in range(grid + 1)]
    cells = (_with_brackets(d, brackets, gk, few, ps).select(*gk, cell.alias("_cell"), F.when(cell % 2 == 1, F.col(value_col)).alias("_v"))
             .groupBy(*gk, "_cell").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_l"), F.max("_v").alias("_h"),
                                        F.percentile_approx("_v", cuts, max(accuracy, 4 * grid)).alias("_s")))
    w = Window.partitionBy(*gk).orderBy("_cell")           # at most two rows for each quantile and one
    cells = cells.withColumn("_first", F.sum("_c").over(w) - F.col("_c"))
    both = cells.join(brackets, gk)
    aggs = []
    for i, (lo, hi, _) in enumerate(_wanted(ps)):
        def edge(r, s):
            inside = (F.col("_cell") % 2 == 1) & (F.col("_first") <= r) & (r < F.col("_first") + F.col("_c"))
            k = F.floor((r - F.col("_first")) * grid / F.col("_c")) + 2 * s
            cut = F.when(k < 0, F.col("_l")).when(k >= grid, F.col("_h")).otherwise(F.element_at("_s", (k + 1).cast("int")))
            kept = F.when(F.col("_l") == F.col("_h"), F.col("_l")).otherwise(cut)
            return F.max(F.when(inside, kept))
        # a rank that is in no bracket keeps the bracket it had: the last count shows it and the group is ranked whole
        aggs += [F.coalesce(edge(lo, -1), F.first(f"_lo{i}")).alias(f"_lo{i}"), F.coalesce(edge(hi, 1), F.first(f"_hi{i}")).alias(f"_hi{i}")]
    most = F.max(F.when(F.col("_l") < F.col("_h"), F.col("_c")).otherwise(0)).alias("_most")
    out = materialize(both.groupBy(*gk, *carried, "_n", "_mn", "_mx").agg(*aggs, most))
    held = out.agg(F.max("_most")).first()[0] or 0
    return out.drop("_most"), held * 6 // grid
