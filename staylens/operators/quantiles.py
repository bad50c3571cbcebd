"""Exact quantiles per group without gathering a group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylens.operators.joins import null_safe_join
from staylens.session import keep

# Columns whose sketches one aggregate holds.
COLUMNS_AT_ONCE = 200

# Up to this many values per group the built-in exact percentile is used: its
# per-group value map then has a proven size.
SMALL_GROUP = 50_000
ACCURACY = 10_000
BRACKET_ROWS_BROADCAST = 100_000


def exact_quantiles(
    long: DataFrame,
    keys: list[str],
    value: str,
    probabilities: list[float],
    group_rows: int,
    small_group: int = SMALL_GROUP,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Interpolated quantiles of ``value`` per ``keys``: columns keys, q, value.

    ``group_rows`` is an upper bound of the rows in one group. Beyond
    ``small_group`` a first pass finds, with the mergeable sketch, a narrow
    bracket around every wanted rank; a second pass counts what lies below the
    bracket and the distinct values inside it, which gives the exact value. A
    bracket that misses its rank is widened until it holds.
    """
    rows = long.filter(F.col(value).isNotNull())
    if group_rows <= small_group:
        points = F.array(*[F.lit(p) for p in probabilities])
        exact = rows.groupBy(*keys).agg(F.percentile(value, points).alias("_v"))
        pairs = F.arrays_zip(points.alias("q"), F.col("_v").alias("value"))
        return exact.select(*keys, F.explode(pairs).alias("_p")).select(
            *keys, F.col("_p.q").alias("q"), F.col("_p.value").alias("value")
        )
    margin = 2.0 / accuracy
    while True:
        found = keep(_bracketed(rows, keys, value, probabilities, accuracy, margin), "quantiles")
        if margin >= 1 or not found.filter(F.col("value").isNull()).limit(1).count():
            return found
        margin *= 16


def _bracketed(
    rows: DataFrame, keys: list[str], value: str, probabilities: list[float], accuracy: int, margin: float
) -> DataFrame:
    edges = [min(max(p + side, 0.0), 1.0) for p in probabilities for side in (-margin, margin)]
    sketch = rows.groupBy(*keys).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(value, edges, accuracy).alias("_edges"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    brackets = F.array(
        *[
            F.struct(
                F.lit(p).alias("q"),
                (F.col("_min") if p - margin <= 0 else F.col("_edges")[2 * i]).alias("lo"),
                (F.col("_max") if p + margin >= 1 else F.col("_edges")[2 * i + 1]).alias("hi"),
            )
            for i, p in enumerate(probabilities)
        ]
    )
    marks = keep(sketch.select(*keys, "_n", F.explode(brackets).alias("_b")).select(*keys, "_n", "_b.*"), "brackets")
    side = F.broadcast(marks) if marks.count() <= BRACKET_ROWS_BROADCAST else marks
    # Values below the bracket fall into one NULL cell: only their number matters.
    cells = (
        null_safe_join(rows, side, keys)
        .filter(F.col(value) <= F.col("hi"))
        .groupBy(*keys, "q", "_n", F.when(F.col(value) >= F.col("lo"), F.col(value)).alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    running = Window.partitionBy(*keys, "q").orderBy(F.asc_nulls_first("_cell"))
    position = (F.col("_n") - 1) * F.col("q")
    ranked = cells.withColumn("_upto", F.sum("_rows").over(running)).withColumn("_from", F.col("_upto") - F.col("_rows"))

    def value_at(rank):
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_upto")), F.col("_cell")))

    low, high = value_at(F.floor(position)), value_at(F.ceil(position))
    share = F.max(position - F.floor(position))
    return ranked.groupBy(*keys, "q").agg((low + (high - low) * share).alias("value"))


def column_medians(df: DataFrame, columns: list[str], accuracy: int = ACCURACY) -> dict[str, dict]:
    """Exact median and moments of every numeric column, without a row per cell.

    Gives, per column, rows, n (values), mean, var and median (None without a
    value); NULL and NaN are no values. A wide aggregate of mergeable sketches
    brackets each median; where the bracket is one value, that is the median. For
    the other columns a second pass counts what lies below the bracket, and only
    cells inside it are regrouped by column. One row per column returns.
    """
    found = {}
    for low in range(0, len(columns), COLUMNS_AT_ONCE):
        found |= _some_medians(df, columns[low : low + COLUMNS_AT_ONCE], accuracy)
    return found


def _some_medians(df: DataFrame, columns: list[str], accuracy: int) -> dict[str, dict]:
    def value(column):
        number = F.col(f"`{column.replace('`', '``')}`").cast("double")
        return F.when(~F.isnan(number), number)

    rows = df.count()
    margin = max(2.0 / accuracy, 2.0 / max(rows, 1))
    edges = [max(0.5 - margin, 0.0), min(0.5 + margin, 1.0)]
    while True:
        wide = []
        for i, c in enumerate(columns):
            v = value(c)
            wide += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.var_pop(v).alias(f"var{i}")]
            wide += [F.percentile_approx(v, edges, accuracy).alias(f"e{i}"), F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}")]
        r = df.agg(*wide).first()
        out, inside = {}, []
        for i, c in enumerate(columns):
            out[c] = {"rows": rows, "n": r[f"n{i}"], "mean": r[f"mean{i}"], "var": r[f"var{i}"], "median": None}
            if not r[f"n{i}"]:
                continue
            least = r[f"min{i}"] if edges[0] <= 0 else r[f"e{i}"][0]
            most = r[f"max{i}"] if edges[1] >= 1 else r[f"e{i}"][1]
            if least == most:
                out[c]["median"] = least
            else:
                inside.append((i, c, least, most))
        if not inside:
            return out
        for c, median in _inside_brackets(df, inside, {c: out[c]["n"] for _, c, _, _ in inside}, value).items():
            out[c]["median"] = median
        # Few values in a column of mostly NULLs can lie outside; then look wider.
        if all(x["median"] is not None or not x["n"] for x in out.values()):
            return out
        edges = [max(0.5 - (0.5 - edges[0]) * 16, 0.0), min(0.5 + (edges[1] - 0.5) * 16, 1.0)]


def _inside_brackets(df: DataFrame, brackets: list[tuple], counts: dict[str, int], value) -> dict[str, float]:
    """Median of each (position, column, low, high); None where a rank lies outside."""
    below = df.agg(*[F.count_if(value(c) < low).alias(f"b{i}") for i, c, low, _ in brackets]).first()
    cells = F.array(*[F.when(value(c).between(low, high), F.struct(F.lit(i).alias("at"), value(c).alias("v"))) for i, c, low, high in brackets])
    counted = df.select(F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("x")).groupBy("x.at", "x.v").agg(F.count(F.lit(1)).alias("rows"))
    ranks = {i: below[f"b{i}"] for i, *_ in brackets}
    first = F.create_map(*[F.lit(x) for i, b in ranks.items() for x in (i, b)])[F.col("at")]
    upto = first + F.sum("rows").over(Window.partitionBy("at").orderBy("v"))
    ranked = counted.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("rows"))
    size = F.create_map(*[F.lit(x) for i, c, *_ in brackets for x in (i, counts[c])])[F.col("at")]
    middle = (size - 1) / 2.0

    def at_rank(rank):
        return F.max(F.when((F.col("from") <= rank) & (rank < F.col("upto")), F.col("v")))

    low, high = at_rank(F.floor(middle)), at_rank(F.ceil(middle))
    found = {r["at"]: r["median"] for r in ranked.groupBy("at").agg((low + (high - low) * F.lit(0.5)).alias("median")).collect()}
    return {c: found.get(i) for i, c, *_ in brackets}
