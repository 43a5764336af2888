"""Robust local regression (LOWESS) at every distinct x, in time linear in them but for logarithms.

The distinct x are sorted and numbered once and cut into blocks of rows.  Every
question about a row's window (how far its k-th nearest point is, the sums over
the part of the window in some block) goes to one block.  Windows move on with
x, so the rows of one block ask a run of neighbouring blocks: of the pairs of
blocks that meet there are at most twice as many as blocks, and each pair is a
task of its own with at most one block of rows and of questions, however the
points lie.  Sums over whole blocks come from the blocks' moments
(`functions.local_lines`).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rinkflow.functions.local_lines import SUMS, Nodes, Tree
from rinkflow.operators.quantiles import exact_quantiles
from rinkflow.session import materialize
from rinkflow.workers import ship

#: Blocks have at least this many distinct x, more where there would be more than MOST_BLOCKS.
BLOCK_ROWS = 1 << 14
#: Bounds what the driver and the tasks hold of every block: its ends and 23 moments.
MOST_BLOCKS = 1 << 14

_LOCAL = (1 << 33) - 1


class _Index:
    """``rows`` (row, block, x, n, start) of the distinct x in order: ``start`` points come before.

    ``first``, ``last`` and ``start`` hold the ends and the first point of each
    block; ``points`` is the number of points.
    """

    def __init__(self, points, block_rows):
        spark = points.sparkSession
        rows = points.groupBy("x").agg(F.count("*").alias("n")).repartitionByRange("x").sortWithinPartitions("x")
        rows = materialize(rows.select(F.monotonically_increasing_id().alias("id"), "x", "n"))
        part = F.shiftright("id", 33).alias("part")
        # One row for each partition of the sort.
        parts = rows.groupBy(part).agg(F.count("*").alias("m"), F.sum("n").alias("n")).orderBy("part").collect()
        befores, m, n = [], 0, 0
        for p in parts:
            befores.append((p["part"], m, n))
            m, n = m + p["m"], n + p["n"]
        self.points, self.distinct = n, m
        if not m:
            return
        per = max(block_rows, -(-m // MOST_BLOCKS))
        befores = spark.createDataFrame(befores, "part long, row0 long, start0 long")
        ahead = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
        numbered = (
            rows.select("id", part, "x", "n")
            .withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
            .join(F.broadcast(befores), "part")
            .select((F.col("row0") + F.col("id").bitwiseAND(_LOCAL)).alias("row"), "x", "n", F.expr("start + start0").alias("start"))
        )
        self.rows = materialize(numbered.select("row", F.floor(F.col("row") / per).alias("block"), "x", "n", "start"))
        ends = self.rows.groupBy("block").agg(F.min("x"), F.max("x"), F.min("start")).orderBy("block").collect()
        _, self.first, self.last, self.start = (np.array(c) for c in zip(*ends))


def _each_batch(df, function, schema):
    """``df`` through a function from a dict of arrays to a list of such dicts."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for out in function({c: batch.column(c).to_numpy() for c in batch.schema.names}):
                yield pa.RecordBatch.from_arrays([pa.array(out[c]) for c in names], names=names)

    return df.mapInArrow(run, schema)


def _pairs(requests, on=()):
    """The pairs of blocks that meet: at most two for each block and kind of request."""
    return materialize(requests.select("chunk", "block", *on).distinct())


def _meet(requests, rows, pairs, answer, schema, on=()):
    """``answer(requests, rows)`` for every pair of a block that asks (chunk) and one that is asked.

    Both come as dicts of arrays, the rows in the order of x.
    """
    keys = ["chunk", "block", *on]
    names = [f.split()[0] for f in schema.split(", ")]
    # A block of rows goes to each block that asks it.
    asked = rows.join(F.broadcast(pairs), ["block", *on])

    def run(asking, table):
        table = {c: table.column(c).to_numpy() for c in table.column_names}
        order = np.argsort(table["x"])
        found = answer({c: asking.column(c).to_numpy() for c in asking.column_names}, {c: v[order] for c, v in table.items()})
        return pa.table({c: found[c] if isinstance(found[c], pa.Array) else pa.array(found[c]) for c in names})

    return requests.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(run, schema)


def _half_sums(index, k):
    """(row, block, x, kind, s): twice the centre of the window that a row just closes.

    With the k points from a row on (kind 0) the row is the left end and s the
    sum of both ends; with the k points up to it (kind 1) it is the right end.
    Rows with fewer points on that side have none.  s grows with the row.
    """
    starts, total = index.start, index.points

    def ask(rows):
        for kind, place in ((0, rows["start"] + k - 1), (1, rows["start"] + rows["n"] - k)):
            use = (place >= 0) & (place < total)
            block = np.searchsorted(starts, place[use], "right") - 1
            yield {
                "chunk": rows["block"][use], "block": block, "row": rows["row"][use], "x": rows["x"][use],
                "place": place[use], "kind": np.full(len(block), kind, np.int32),
            }

    requests = materialize(
        _each_batch(index.rows, ask, "chunk long, block long, row long, x double, place long, kind int")
    )

    def answer(asking, table):
        end = table["x"][np.searchsorted(table["start"], asking["place"], "right") - 1]
        return {"row": asking["row"], "block": asking["chunk"], "x": asking["x"], "kind": asking["kind"], "s": asking["x"] + end}

    return materialize(
        _meet(requests, index.rows, _pairs(requests), answer, "row long, block long, x double, kind int, s double")
    )


def _widths(index, k):
    """(block, x, h): the distance of the k-th nearest point to each distinct x."""
    sums = _half_sums(index, k)
    ends = sums.groupBy("kind", "block").agg(F.min("s").alias("low"), F.max("s").alias("high")).orderBy("block").collect()
    blocks = [np.array([e["block"] for e in ends if e["kind"] == kind]) for kind in (0, 1)]
    low = np.array([e["low"] for e in ends if e["kind"] == 0])
    high = np.array([e["high"] for e in ends if e["kind"] == 1])

    def ask(rows):
        # The nearest left end whose window still reaches as far to the right, and the other way round.
        twice = 2 * rows["x"]
        places = [np.searchsorted(low, twice, "right") - 1, np.searchsorted(high, twice, "left")]
        for kind, place in enumerate(places):
            use = (place >= 0) & (place < len(blocks[kind]))
            yield {
                "chunk": rows["block"][use], "block": blocks[kind][place[use]], "x": rows["x"][use],
                "kind": np.full(int(use.sum()), kind, np.int32),
            }

    requests = materialize(_each_batch(index.rows, ask, "chunk long, block long, x double, kind int"))

    def answer(asking, table):
        twice = 2 * asking["x"]
        if asking["kind"][0] == 0:
            h = asking["x"] - table["x"][np.searchsorted(table["s"], twice, "right") - 1]
        else:
            h = table["x"][np.searchsorted(table["s"], twice, "left")] - asking["x"]
        return {"block": asking["chunk"], "x": asking["x"], "h": h}

    found = _meet(requests, sums, _pairs(requests, ["kind"]), answer, "block long, x double, h double", ["kind"])
    return materialize(found.groupBy("block", "x").agg(F.min("h").alias("h")))


def _window_parts(index, widths):
    """Requests (chunk, block, x, h, whole_from, whole_to) for the sums over each window.

    A window asks its own block, which also adds the whole blocks from
    ``whole_from`` up to but not with ``whole_to``, and the blocks that hold its ends
    unless they lie in it as a whole.
    """
    first, last = index.first, index.last

    def ask(rows):
        own, x, h = rows["block"], rows["x"], rows["h"]
        left = np.maximum(np.searchsorted(first, x - h, "right") - 1, 0)
        right = np.searchsorted(first, x + h, "right") - 1
        left, right = np.minimum(left, own), np.maximum(right, own)
        cut_left = (left < own) & (x - first[left] >= h)
        cut_right = (right > own) & (last[right] - x >= h)
        yield {"chunk": own, "block": own, "x": x, "h": h, "whole_from": left + cut_left, "whole_to": right + 1 - cut_right}
        for cut, block in ((cut_left, left), (cut_right, right)):
            none = np.zeros(int(cut.sum()), np.int64)
            yield {"chunk": own[cut], "block": block[cut], "x": x[cut], "h": h[cut], "whole_from": none, "whole_to": none}

    schema = "chunk long, block long, x double, h double, whole_from long, whole_to long"
    return materialize(_each_batch(widths, ask, schema))


def _block_nodes(weighted):
    """The nodes of all blocks, in order, on the driver: at most MOST_BLOCKS."""

    def root(table):
        x = table.column("x").to_numpy()
        order = np.argsort(x)
        top = Tree(Nodes.of_rows(*(table.column(c).to_numpy()[order] for c in ("x", "w", "wy")))).root()
        moments = lambda m: pa.array([[float(v[0]) for v in m]], pa.list_(pa.float64()))
        return pa.table(
            {
                "block": pa.array([table.column("block")[0].as_py()], pa.int64()),
                "low": top.low, "high": top.high, "weights": moments(top.weights), "values": moments(top.values),
            }
        )

    schema = "block long, low double, high double, weights array<double>, values array<double>"
    found = weighted.groupBy("block").applyInArrow(root, schema).orderBy("block").collect()
    columns = lambda c: list(np.array([r[c] for r in found]).T)
    return Nodes(np.array([r["low"] for r in found]), np.array([r["high"] for r in found]), columns("weights"), columns("values"))


def _within(rows, x, h):
    """The range of rows nearer than ``h``; those at that very distance have no weight."""
    last = len(rows) - 1
    low = np.searchsorted(rows, x - h, "left")
    low -= (low > 0) & (x - rows[np.maximum(low - 1, 0)] < h)
    low += (low <= last) & (x - rows[np.minimum(low, last)] >= h)
    high = np.searchsorted(rows, x + h, "right")
    high += (high <= last) & (rows[np.minimum(high, last)] - x < h)
    high -= (high > 0) & (rows[np.maximum(high - 1, 0)] - x >= h)
    return low, high


# Value at its centre of the line through the sums. A window without slope (weight on places less than a
# thousandth of its half-width apart) has its weighted mean; one that keeps hardly any of its weight has none.
_LINE_VALUE = """
CASE WHEN w <= 1e-8 * before THEN NULL
     WHEN w * tt - t * t > 1e-6 * w * w THEN (tt * y - t * ty) / (w * tt - t * t)
     ELSE y / w END"""


def _fit(weighted, requests, pairs, otherwise):
    """(block, x, trend) from rows (block, x, w, wy, last) and the windows' requests.

    ``otherwise`` is the trend where there is no line: ``mean``, the weighted one, or ``last``.
    """
    spark = weighted.sparkSession
    blocks = spark.sparkContext.broadcast(Tree(_block_nodes(weighted)))

    def answer(asking, table):
        x, h, rows = asking["x"], asking["h"], table["x"]
        tree = Tree(Nodes.of_rows(rows, table["w"], table["wy"]))
        low, high = _within(rows, x, h)
        none, every = np.zeros(len(x), np.int64), np.full(len(x), len(rows))
        own, asked = asking["chunk"][0], asking["block"][0]
        last = pa.nulls(len(x), pa.float64())
        if asked < own:
            sums = tree.sums(low, every, x, h, -1)
        elif asked > own:
            sums = tree.sums(none, high, x, h, 1)
        else:
            at = np.searchsorted(rows, x)
            sums = tree.sums(low, at, x, h, -1) + tree.sums(at + 1, high, x, h, 1)
            sums[0] += table["w"][at]
            sums[3] += table["wy"][at]
            sums[5] += table["w"][at]
            here = np.full(len(x), own)
            sums += blocks.value.sums(asking["whole_from"], here, x, h, -1)
            sums += blocks.value.sums(here + 1, asking["whole_to"], x, h, 1)
            last = table["last"][at]
        return {"own": asking["chunk"], "x": x, "last": last, **dict(zip(SUMS, sums))}

    schema = "own long, x double, last double, " + ", ".join(f"{c} double" for c in SUMS)
    parts = _meet(requests, weighted, pairs, answer, schema)
    sums = parts.groupBy(F.col("own").alias("block"), "x").agg(*[F.sum(c).alias(c) for c in SUMS], F.max("last").alias("last"))
    sums = sums.selectExpr("block", "x", f"{_LINE_VALUE} AS trend", "last", "CASE WHEN w > 0 THEN y / w END AS mean")
    fit = materialize(sums.select("block", "x", F.coalesce("trend", otherwise).alias("trend")))
    blocks.destroy()
    return fit


def lowess_trend(df: DataFrame, x, y, frac=2 / 3, iters=3, block_rows=BLOCK_ROWS):
    """Trend of ``y`` at every distinct ``x``: columns ``x`` and ``trend``.

    ``frac`` of the points (at least two) take part in each local line;
    ``iters`` rounds weigh points down by their residuals.  Rows where either is NULL, NaN
    or infinite do not count.  Where the weight lies on (nearly) one place the trend is the
    weighted mean, and where hardly any is left the previous round's value.
    """
    ship(df.sparkSession)
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    points = materialize(points.where("abs(x) < double('infinity') AND abs(y) < double('infinity')"))
    index = _Index(points, block_rows)
    if not index.distinct:
        return points.selectExpr("x", "y AS trend")
    k = min(max(2, int(frac * index.points)), index.points)
    requests = _window_parts(index, _widths(index, k))
    pairs = _pairs(requests)

    sums = points.groupBy("x").agg(F.expr("double(count(*)) AS w"), F.sum("y").alias("wy"))
    weighted = index.rows.select("block", "x").join(sums, "x").withColumn("last", F.lit(None).cast("double"))
    fit = _fit(materialize(weighted), requests, pairs, "mean")
    for _ in range(iters):
        # The points meet their trend once in a round; their residuals are read from there.
        rows = materialize(points.join(fit, "x").selectExpr("block", "x", "y", "trend", "abs(y - trend) AS r"))
        scale = exact_quantiles(rows, "r", [0.5], written=True).selectExpr("6 * q0 AS s").scalar()
        share = "CASE WHEN scale > 0 THEN least(r / scale, 1D) ELSE double(r != 0) END"
        weighted = rows.withColumn("scale", scale).selectExpr("block", "x", "y", "trend", f"pow(1D - pow({share}, 2), 2) AS w")
        weighted = weighted.groupBy("block", "x").agg(F.expr("sum(w) AS w"), F.expr("sum(w * y) AS wy"), F.max("trend").alias("last"))
        fit = _fit(materialize(weighted), requests, pairs, "last")
    return fit.select("x", "trend")
