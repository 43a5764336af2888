"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Trees are fitted on a bounded sample and hold every vector; a query walks all
trees from one priority queue, nearest regions first, and the vectors of the
leaves it reaches are scored exactly.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow.llm.workers import ship
from rinkflow.session import materialize

#: Vectors that the trees are fitted on at most, and those of them in a leaf at least.
SAMPLE, LEAF = 65_536, 128
#: Leaves of a tree at most: with them the leaves that a query visits are bounded, whatever the table's size.
LEAVES = 64
TREES = 12
#: Vectors whose margins to all planes are held at once.
ROWS = 1024
#: Queries and recall by which the number of leaves to visit is set.
PROBES, RECALL = 200, 0.95
#: Vectors and queries that meet in one task; larger leaves are dealt out in parts.
PART = 1 << 16


class Forest:
    """Balanced trees: a node splits its sample at the median of a random projection."""

    def __init__(self, sample, norm, seed=7):
        """``norm``: the largest norm. One more coordinate fills every vector up to
        it, so that the nearest in angle is the one with the largest inner product."""
        self.norm = norm
        self.depth = 0
        while len(sample) >> self.depth > LEAF and 1 << self.depth < LEAVES:
            self.depth += 1
        self.leaves = 1 << self.depth
        rng = np.random.default_rng(seed)
        points = self.filled(sample)
        width = points.shape[1]
        self.planes = np.zeros((TREES, self.leaves - 1, width), np.float32)
        self.cuts = np.zeros((TREES, self.leaves - 1), np.float32)
        for t in range(TREES):
            groups = [np.arange(len(points))]
            for node in range(self.leaves - 1):
                own = groups[node]
                plane = rng.standard_normal(width)
                if len(own) > 1:
                    a, b = points[own[rng.integers(0, len(own), 2)]]
                    if np.any(a != b):
                        plane = a - b
                plane = plane / np.linalg.norm(plane)
                side = points[own] @ plane
                cut = np.median(side) if len(own) else 0.0
                order = np.argsort(side, kind="stable")
                half = len(own) // 2
                groups += [own[order[:half]], own[order[half:]]]
                self.planes[t, node], self.cuts[t, node] = plane, cut
        self.visits = self._calibrated(sample, rng)

    def filled(self, vectors):
        rest = self.norm**2 - np.einsum("ij,ij->i", vectors, vectors, dtype=float)
        return np.column_stack([vectors, np.sqrt(np.maximum(rest, 0))]).astype(np.float32)

    def margins(self, points):
        """Signed distances to the cuts: points x trees x nodes."""
        flat = self.planes.reshape(-1, self.planes.shape[-1])
        return (points @ flat.T).reshape(len(points), TREES, -1) - self.cuts

    def assign(self, vectors):
        """The leaf of each vector in each tree; margins are held for ROWS vectors at a time."""
        out = [np.zeros((0, TREES), np.int64)]
        for a in range(0, len(vectors), ROWS):
            margins = self.margins(self.filled(vectors[a : a + ROWS]))
            node = np.zeros((len(margins), TREES), np.int64)
            for _ in range(self.depth):
                up = np.take_along_axis(margins, node[:, :, None], 2)[:, :, 0] >= 0
                node = 2 * node + 1 + up
            out.append(node - (self.leaves - 1))
        return np.concatenate(out)

    def search(self, margins, visits):
        """(tree, leaf) of the ``visits`` leaves nearest to a query: one queue for all trees."""
        queue = [(-np.inf, t, 0) for t in range(TREES)]
        out = []
        while queue and len(out) < visits:
            distance, t, node = heapq.heappop(queue)
            while node < self.leaves - 1:
                margin = margins[t][node]
                near, far = 2 * node + 1 + (margin >= 0), 2 * node + 1 + (margin < 0)
                heapq.heappush(queue, (max(distance, abs(margin)), t, far))
                node = near
            out.append((t, node - (self.leaves - 1)))
        return out

    def leaves_of(self, queries, visits=None):
        points = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
        scale = np.linalg.norm(points, axis=1, keepdims=True)
        points *= self.norm / np.where(scale > 0, scale, 1)
        return [self.search(m.tolist(), visits or self.visits) for p in points for m in self.margins(p[None])]

    def _calibrated(self, sample, rng):
        """The fewest leaves, a sixth more each time, that find RECALL of the sample's neighbours."""
        most = TREES * self.leaves
        if self.leaves == 1:
            return most
        probes = rng.choice(len(sample), min(PROBES, len(sample)), replace=False)
        near = np.argsort(-(sample[probes] @ sample.T), axis=1)[:, :21]
        leaf = self.assign(sample)
        visits = TREES
        while visits < most:
            found = 0
            for wanted, leaves in zip(near, self.leaves_of(sample[probes], visits)):
                t, at = np.array(leaves).T
                seen = np.zeros((TREES, self.leaves), bool)
                seen[t, at] = True
                found += seen[np.arange(TREES), leaf[wanted]].any(axis=1).sum()
            if found >= RECALL * near.size:
                break
            visits = min(most, visits + visits // 6 + 1)
        return visits


def _vectors(column):
    return np.stack([np.frombuffer(x.as_buffer(), "<f4") for x in column]) if len(column) else np.zeros((0, 1))


def usable(vectors, id_column, vector_column):
    """(vec_id, vector): rows with an id and a finite vector that is not zero, of the usual length."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<float>").alias("vector"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("vector") == (lengths[0] if lengths else 0))


_PACK = "vec_id long, vector binary"


def _packed(batches):
    for batch in batches:
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f4")
        rows = flat.reshape(batch.num_rows, -1) if batch.num_rows else []
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["vec_id", "vector"]
        )


def nearest(vectors, every=20, k=20, id_column="vec_id", vector_column="embedding"):
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``.

    Nearness is the largest inner product, in double precision on the given
    components; ties go to the smaller id; a row is not its own neighbour.

    Defined results: rows with a null id, and vectors that are null, zero, of
    another length than most or with null or non-finite components take no
    part. Repeated rows count once; an id with several vectors is searched with
    each and ranked by its best score. With k candidates or fewer all are
    returned. Other columns are ignored; an empty table gives no rows.

    Equal vectors form one class that is searched once, with its k + 1 smallest
    ids, so a vector that a third of all rows share costs no more than another.
    A leaf's vectors and the queries that reach it meet in parts of bounded
    size. The trees are fitted on SAMPLE vectors at most; every vector is in a
    leaf of each tree. The leaves to visit are set by RECALL on the sample.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = materialize(usable(vectors, id_column, vector_column).mapInArrow(_packed, _PACK).distinct())
    keyed = rows.select("vec_id", F.xxhash64("vector").alias("x"), F.xxhash64(F.lit(1), "vector").alias("y"))
    classes = keyed.groupBy("x", "y").agg(F.min("vec_id").alias("class"))
    members = materialize(keyed.join(classes, ["x", "y"]).select("vec_id", "class", "x"))
    # An id with several vectors can stand for several classes: the hash tells them apart.
    key = ["class", "x"]
    points = rows.select(F.col("vec_id").alias("class"), F.xxhash64("vector").alias("x"), "vector")
    points = materialize(points.join(members.select(*key).distinct(), key, "left_semi"))
    n = points.count()
    asked = members.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    wanted = asked.select(*key).distinct()
    queries = materialize(points.join(wanted, key, "left_semi"))
    n_queries = queries.count()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    sample = points.orderBy(F.xxhash64("class", F.lit(5)), "x").limit(SAMPLE).select("vector").collect()
    norm = points.select(F.max(_norm("vector"))).first()[0]
    forest = Forest(np.stack([np.frombuffer(r[0], "<f4") for r in sample]).astype(float), norm)
    held = spark.sparkContext.broadcast(forest)
    parts = max(1, -(-n // (forest.leaves * PART)))
    blocks = max(1, -(-n_queries * forest.visits // (forest.leaves * TREES * PART)))

    def to_leaves(batches):
        forest = held.value
        for batch in batches:
            if batch.num_rows:
                leaf = forest.assign(_vectors(batch.column(2)).astype(float)) + np.arange(TREES) * forest.leaves
                yield _dealt(batch, leaf.ravel(), np.repeat(np.arange(batch.num_rows), TREES))

    def to_visits(batches):
        forest = held.value
        for batch in batches:
            if batch.num_rows:
                found = forest.leaves_of(_vectors(batch.column(2)).astype(float))
                bins = np.array([t * forest.leaves + leaf for own in found for t, leaf in own])
                yield _dealt(batch, bins, np.repeat(np.arange(batch.num_rows), [len(x) for x in found]))

    schema = "bin long, class long, x long, vector binary"
    stored = points.mapInArrow(to_leaves, schema)
    stored = stored.withColumn("part", F.pmod("x", F.lit(parts))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    visits = queries.mapInArrow(to_visits, schema)
    visits = visits.withColumn("block", F.pmod("x", F.lit(blocks)).cast("int")).withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
    )

    def score(asking, there):
        if not asking.num_rows or not there.num_rows:
            return _scores([], [], [], [], [])
        q, v = (_vectors(t.column("vector").combine_chunks()).astype(float) for t in (asking, there))
        ids = [there.column(c).to_numpy() for c in key]
        own = [asking.column(c).to_numpy() for c in key]
        out = []
        for a in range(0, len(q), 1024):
            scores = q[a : a + 1024] @ v.T
            for i, row in enumerate(scores, a):
                best = np.arange(len(row))
                if len(row) > k + 1:
                    least = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                    best = np.flatnonzero(row >= least)
                best = best[np.lexsort((ids[0][best], -row[best]))][: k + 1]
                out.append((np.full(len(best), own[0][i]), np.full(len(best), own[1][i]), ids[0][best], ids[1][best], row[best]))
        return _scores(*map(np.concatenate, zip(*out)))

    at = ["bin", "part", "block"]
    scored = visits.groupBy(*at).cogroup(stored.groupBy(*at)).applyInArrow(
        score, "q_class long, q_x long, class long, x long, score double"
    )
    asker = ["q_class", "q_x"]
    scored = scored.groupBy(*asker, *key).agg(F.max("score").alias("score"))
    nearest_first = Window.partitionBy(*asker).orderBy(F.desc("score"), "class", "x")
    top = scored.withColumn("r", F.row_number().over(nearest_first)).where(F.col("r") <= k + 1).drop("r")
    smallest = Window.partitionBy(*key).orderBy("vec_id")
    few = members.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).drop("r")
    by_id = Window.partitionBy(*asker).orderBy(F.desc("score"), "vec_id")
    found = top.join(few, key).select(*asker, "vec_id", "score")
    found = found.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= 2 * (k + 1)).drop("r")
    asked = asked.select("query_id", F.col("class").alias("q_class"), F.col("x").alias("q_x"))
    answers = asked.join(found, asker).where("query_id <> vec_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _norm(column):
    """The Euclidean norm of packed vectors."""

    @F.pandas_udf("double")
    def norm(x):
        return x.map(lambda b: float(np.linalg.norm(np.frombuffer(b, "<f4").astype(float))))

    return norm(column)


def _dealt(batch, bins, rows):
    take = pa.array(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(bins.astype(np.int64)), *(batch.column(i).take(take) for i in range(3))],
        names=["bin", "class", "x", "vector"],
    )


def _scores(q_class, q_x, own, x, score):
    arrays = [pa.array(a, pa.int64()) for a in (q_class, q_x, own, x)] + [pa.array(score, pa.float64())]
    return pa.Table.from_arrays(arrays, names=["q_class", "q_x", "class", "x", "score"])
