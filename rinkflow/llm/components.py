"""Connected components of a table of links, by alternating large and small stars."""

from pyspark.sql import functions as F

from rinkflow.session import materialize


def _pairs(df, child, parent):
    return df.select(F.col(child).alias("a"), F.col(parent).alias("b")).where("a <> b").distinct()


def components(links):
    """(id, component_id) for every id in ``links`` (a, b): the smallest id reachable.

    Each step hooks the neighbours of every id to their smallest one, first the
    larger neighbours, then the others, until nothing changes (a number of
    steps that grows with the square of the logarithm of the longest chain).
    Minima combine before the shuffle, so no neighbourhood is ever gathered.
    Steps are written to the shared folder. Links with a null are ignored; an
    empty table gives no rows.
    """
    links = links.where("a is not null and b is not null")
    edges = materialize(_pairs(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "a", "b"))
    before = None
    while True:
        # Large star: every larger neighbour of an id goes to the id's smallest neighbour.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        large = both.where("b > a").join(least, "a")
        edges = _pairs(large, "b", "least")
        # Small star: the smaller neighbours of an id and itself go to the smallest of them.
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        small = edges.join(least, "a")
        edges = materialize(_pairs(small, "b", "least").unionByName(_pairs(least, "a", "least")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(20,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if now == before:
            break
        before = now
    found = edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    return found.unionByName(found.select(F.col("component_id").alias("id"), "component_id").distinct())
