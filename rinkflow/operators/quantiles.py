"""Exact quantiles by refinement, and what builds on them.

A quantile needs one or two order statistics, yet the built-in exact
``percentile`` holds every distinct value of a group in one task.  Here values
are only counted, in bins that keep their order: first by logarithm, then, inside the few
bins that hold a wanted rank, by equal widths between the bin's least and
greatest value, until those are the same.  Counts combine on the map side, so no
value is shuffled or sorted.  A bin of the first pass spans a factor of less than
two, so its at most 52 bits are used up after 52 / log2(bins) further passes;
one or two are usual.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.session import materialize

#: Bins to a bracket and pass; a bracket with fewer values counts each of them.
BINS = 1 << 13
#: Bins to a factor of two in the first pass.
LOG_BINS = 64

# Grows with _v: doubles lie between 2^-1074 and 2^1024.
_LOG_BIN = f"""CASE WHEN _v = 0 THEN 0
  WHEN abs(_v) = double('infinity') THEN sign(_v) * {LOG_BINS * 3000}
  ELSE sign(_v) * ({LOG_BINS * 1500} + floor({LOG_BINS} * log2(abs(_v)))) END"""


def _present(df, by, col):
    return df.select(*by, F.col(col).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")


def _joined(rows, other, by):
    """``rows`` with the columns of ``other`` of the same group (nulls equal), one row each."""
    if not by:
        return rows.withColumn("_other", other.select(F.struct("*")).scalar()).select(*rows.columns, "_other.*")
    other = other.withColumnsRenamed({k: f"_{k}" for k in by})
    same = [rows[k].eqNullSafe(other[f"_{k}"]) for k in by]
    return rows.join(other, same).drop(*[f"_{k}" for k in by])


def _holding(bins, within):
    """Bins with the ranks they hold: ``_start`` values of the group come before a bin."""
    ends = f"sum(_c) OVER ({within} ORDER BY _low ROWS UNBOUNDED PRECEDING)"
    bins = bins.selectExpr("*", f"_before + {ends} - _c AS _start")
    held = bins.withColumn("_held", F.expr("filter(_ranks, r -> r._rank >= _start AND r._rank < _start + _c)"))
    return held.where("size(_held) > 0")


def exact_quantiles(df: DataFrame, col, probabilities, by=(), bins=BINS, written=False):
    """Quantiles with linear interpolation, per group.

    Returns ``by`` columns, ``n``, ``min``, ``max`` and ``q0``, ``q1``, ... in
    the order of ``probabilities`` (ascending).  NULL and NaN do not count; a
    group without values has no row.  The values are written once and read in
    each pass; ``written``: ``df`` is a stored table, which is read instead.
    """
    by = list(by)
    groups = [f"`{k}`" for k in by]
    partition = lambda *more: f"PARTITION BY {', '.join([*groups, *more])}" if groups or more else ""
    position = [f"({p!r}D * (n - 1))" for p in probabilities]
    every = range(len(position))
    ranks = ", ".join(
        f"struct({2 * i + j} AS _which, bigint({end}({position[i]})) AS _rank)"
        for i in every
        for j, end in enumerate(("floor", "ceil"))
    )
    values = _present(df, by, col)
    if not written:
        values = materialize(values)

    found = values.groupBy(*by, F.expr(_LOG_BIN).alias("_bin")).agg(
        F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    whole = f"OVER ({partition()})"
    found = found.selectExpr(
        *groups, "_c", "_low", "_high", "0L AS _before",
        f"sum(_c) {whole} AS n", f"min(_low) {whole} AS min", f"max(_high) {whole} AS max",
    ).withColumn("_ranks", F.expr(f"array({ranks})"))
    kept = [*groups, "n", "min", "max", "_c", "_low", "_high", "_start", "_held"]
    held = materialize(_holding(found, partition()).selectExpr(*kept))
    solved = held.where("_low = _high")
    brackets = held.where("_low < _high")
    while not brackets.isEmpty():
        # At most two brackets for each quantile of a group.
        wanted = brackets.groupBy(*by, "n", "min", "max").agg(
            F.collect_list(F.struct("_low", "_high", "_start", "_c", "_held")).alias("_brackets")
        )
        inside = _joined(values, wanted.select(*by, "_brackets"), by).selectExpr(
            *groups, "_v", "get(filter(_brackets, b -> _v >= b._low AND _v <= b._high), 0) AS _b"
        )
        place = f"floor((_v - _b._low) / (_b._high - _b._low) * {bins})"
        finer = (
            inside.where("_b IS NOT NULL")
            .selectExpr(
                *groups, "_v", "_b._low AS _from",
                f"CASE WHEN _b._c <= {bins} THEN _v ELSE double(least({place}, {bins - 1})) END AS _bin",
            )
            .groupBy(*by, "_from", "_bin")
            .agg(F.count("*").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        )
        finer = _joined(finer, wanted, by)
        finer = finer.withColumn("_b", F.expr("get(filter(_brackets, b -> b._low = _from), 0)"))
        finer = finer.selectExpr(
            *groups, "n", "min", "max", "_from", "_c", "_low", "_high", "_b._start AS _before", "_b._held AS _ranks"
        )
        held = materialize(_holding(finer, partition("_from")).selectExpr(*kept))
        solved = solved.unionByName(held.where("_low = _high"))
        brackets = held.where("_low < _high")

    at = solved.selectExpr(*groups, "n", "min", "max", "_low", "inline(_held)")
    picked = at.groupBy(*by, "n", "min", "max").agg(
        *[F.expr(f"max(CASE WHEN _which = {i} THEN _low END) AS _at{i}") for i in range(2 * len(position))]
    )
    return picked.selectExpr(
        *groups, "n", "min", "max",
        *[
            f"_at{2 * i} + (_at{2 * i + 1} - _at{2 * i}) * ({position[i]} - floor({position[i]})) AS q{i}"
            for i in every
        ],
    )


def approximate_quantiles(df: DataFrame, col, probabilities, by=(), accuracy=10_000):
    """One-pass variant: values of approximately the wanted ranks."""
    values = _present(df, by, col)
    found = values.groupBy(*by).agg(
        F.percentile_approx("_v", list(probabilities), accuracy).alias("_q"),
        F.count("*").alias("n"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
    )
    picks = [F.get("_q", F.lit(i)).alias(f"q{i}") for i in range(len(probabilities))]
    return found.select(*by, "n", "min", "max", *picks)


def quartiles(df: DataFrame, col, by=(), approximate=False):
    """First and third quartile and their distance."""
    find = approximate_quantiles if approximate else exact_quantiles
    q = find(df, col, [0.25, 0.75], by)
    return q.select(
        *by, F.col("q0").alias("q1"), F.col("q1").alias("q3"), (F.col("q1") - F.col("q0")).alias("iqr")
    )


def mark_outliers(df: DataFrame, col, k=fixed.OUTLIER_FACTOR, flag="is_outlier"):
    """Flag values strictly outside the fences of the whole of ``df``."""
    q = quartiles(df, col)
    fences = q.selectExpr(f"struct(q1 - {k!r}D * iqr AS low, q3 + {k!r}D * iqr AS high) AS s").scalar()
    return mark_outside(df, col, fences, flag)


def mark_outside(df: DataFrame, col, fences, flag="is_outlier"):
    """Flag values strictly outside ``fences``, a column of (low, high); none if that is NULL."""
    # NaN sorts above everything here; it is no outlier.
    outside = (
        f"coalesce((`{col}` < _fences.low OR `{col}` > _fences.high)"
        f" AND NOT isnan(double(`{col}`)), false) AS `{flag}`"
    )
    columns = [f"`{c}`" for c in df.columns]
    return df.withColumn("_fences", fences).selectExpr(*columns, outside)


def outliers(df: DataFrame, col, k=fixed.OUTLIER_FACTOR):
    """Rows outside the fences of the current selection."""
    return mark_outliers(df, col, k, "_out").where("_out").drop("_out")


def outlier_count(df: DataFrame, col, k=fixed.OUTLIER_FACTOR):
    return outliers(df, col, k).agg(F.count("*").alias("n_outliers"))


def box_by(df: DataFrame, by, value, k=fixed.OUTLIER_FACTOR):
    """Box-plot numbers per group: extremes, quartiles, fences."""
    by = [by] if isinstance(by, str) else list(by)
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], by)
    return q.selectExpr(
        *[f"`{c}`" for c in by],
        "n", "min", "q0 AS q1", "q1 AS median", "q2 AS q3", "max",
        f"q0 - {k!r}D * (q2 - q0) AS lower_fence",
        f"q2 + {k!r}D * (q2 - q0) AS upper_fence",
    )
