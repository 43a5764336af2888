"""Near-duplicate documents by an LSH forest of MinHash signatures.

1. Every text becomes its set of word shingles (64-bit hashes) and a signature:
   for each of ``trees`` trees, DEPTH minima of independent hash functions.
   Texts with equal sets form a class, represented by its smallest id.
2. Each tree is the list of all representatives sorted by their minima.
   Representatives that share at least MIN_DEPTH minima in some tree are
   candidates, nearest first: those with the longest common prefix stand next
   to each other, so the depth at which one looks adapts to how crowded a
   region is. The trees are taken in turns, with components between them: the
   first FIRST trees give next neighbours, then all trees do, then all give
   those within WINDOW places; only those not yet in one component are compared.
3. Candidates are compared by whole signatures, then confirmed on whole sets. In
   regions that hold more than a window's representatives the signatures come to
   the sorted rows, once for each row and tree, so that only alike pairs come out.
4. Regions that hold more than a window's representatives, of several
   components, are searched exactly: what is not in the region's largest
   component is compared on whole sets with everything in the region, in
   blocks, and only links between components come out.

A region is a range of a sorted list that Spark may cut anywhere; rows next to
a cut are compared in a step of their own. No group is gathered or paired off.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow.llm import words as W
from rinkflow.llm.components import components
from rinkflow.llm.workers import release, ship
from rinkflow.session import materialize

#: Minima per tree, of which candidates share the first MIN_DEPTH at least.
DEPTH, MIN_DEPTH = 8, 4
#: Places between candidates in a tree, and trees that are searched before the others.
WINDOW, FIRST = 12, 2
#: The chance that a pair at the threshold shares MIN_DEPTH minima in no tree.
MISS = 1e-5
#: Standard deviations by which a signature may fall short of the threshold.
DEVIATIONS = 5.5
#: Ids of candidates up to this number are broadcast (8 bytes each), more are joined by a shuffle.
FEW_IDS = 4_000_000
#: Bytes of text whose words and shingles a worker holds at a time: some forty bytes for each.
CHUNK_BYTES = 1 << 20
#: Rows of a region that are compared with as many others in one task of the exact search.
BLOCK = 512


def trees_for(percent):
    """Trees that make a pair at the threshold a candidate but for a chance of MISS."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** MIN_DEPTH))


def sets_of(column, shingle):
    """(distinct shingle hashes of each text, offsets of the texts in them)."""
    hashes, at = W.word_hashes(column)
    return W.distinct_per_row(*W.shingle_hashes(hashes, at, shingle))


def _sets_by_chunk(column, shingle):
    """(from, to, hashes, offsets): ``sets_of`` runs of rows with about CHUNK_BYTES of text."""
    for a, b in W.chunks(column, CHUNK_BYTES):
        yield a, b, *sets_of(column.slice(a, b - a), shingle)


def _minima(hashes, offsets, functions):
    """16 bits of the minimum of each hash function over each set; zeros for empty sets."""
    filled = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, functions), ">u2")
    if len(filled):
        starts = offsets[:-1][filled]
        with np.errstate(over="ignore"):
            for j, factor in enumerate(W.randoms(functions, seed=11) | np.uint64(1)):
                least = np.minimum.reduceat(hashes * factor, starts)
                out[filled, j] = (W.mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def _stands_for(hashes, offsets, k):
    """64 bits that stand for each set; zero for empty ones."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    if len(filled):
        with np.errstate(over="ignore"):
            spread = W.mix(hashes ^ W.randoms(2, seed=3)[k])
            out[filled] = np.add.reduceat(spread, offsets[:-1][filled])
    return out.view(np.int64)


def sketch(docs, shingle, trees, id_column="doc_id", text_column="text"):
    """doc_id, text_key, n_shingles, set_a and set_b (128 bits that stand for the set), signature, per row."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for a, b, hashes, offsets in _sets_by_chunk(batch.column(2), shingle):
                signatures = _minima(hashes, offsets, trees * DEPTH)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(np.diff(offsets)),
                        pa.array(_stands_for(hashes, offsets, 0)),
                        pa.array(_stands_for(hashes, offsets, 1)),
                        pa.array([row.tobytes() for row in signatures], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "signature"],
                )
        release()

    text = F.col(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, signature binary"
    )


PAIR, EDGE, WIDE = 0, 1, 2
_SCAN = "kind int, a long, b long, tree int, high long, low long, n long, component long, part int"


def _scan(nodes, trees, window, percent, in_wide=True):
    """Candidates (kind PAIR), rows next to a cut (EDGE) and rows of wide regions (WIDE).

    ``nodes``: id, n, signature, component. Only pairs of different components
    whose sizes allow the threshold are emitted; without ``in_wide`` none of two rows
    that come out as WIDE.
    """
    size = 2 * DEPTH
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.substring(F.col("signature"), t * size + 1, F.lit(size)),
    )
    number = lambda c, at: F.conv(F.hex(F.substring(c, at, F.lit(8))), 16, -10).cast("long")
    rows = (
        nodes.select("id", "n", "component", F.posexplode(keys).alias("tree", "key"))
        .select("tree", number(F.col("key"), F.lit(1)).alias("high"), number(F.col("key"), F.lit(9)).alias("low"), "id", "n", "component")
        .repartitionByRange("tree", "high", "low", "id")
        .sortWithinPartitions("tree", "high", "low", "id")
    )

    def run(batches):
        part = TaskContext.get().partitionId()
        names = ["tree", "high", "low", "id", "n", "component"]
        held, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(i).to_numpy() for i in range(6)]
            old = len(held[0]) if held else 0
            tree, high, low, ids, n, component = all_ = [np.concatenate([h, x]) for h, x in zip(held, new)] if held else new
            out = [[], []]
            wide = np.zeros(len(ids), bool)
            if len(ids) > window + 1:
                far = _same_run(tree, high, window + 1)
                for k in range(window + 2):
                    wide[k : k + len(far)] |= far
                if wide.any():
                    yield _rows(WIDE, [x[wide] for x in all_], part)
            for g in range(1, min(window, len(ids) - 1) + 1):
                fit = _may_link(tree, high, n, component, g, percent)
                fit &= np.arange(g, len(ids)) >= old
                if not in_wide:
                    fit &= ~(wide[g:] & wide[:-g])
                out[0].append(ids[:-g][fit])
                out[1].append(ids[g:][fit])
            if out[0]:
                a, b = np.concatenate(out[0]), np.concatenate(out[1])
                if len(a):
                    yield _candidates(np.minimum(a, b), np.maximum(a, b))
            if first:
                yield _rows(EDGE, [x[:window] for x in all_], part)
                first = False
            held = [x[-(window + 1) :] for x in all_]
        if held:
            yield _rows(EDGE, [x[-window:] for x in held], part)
        release()

    return materialize(rows.mapInArrow(run, _SCAN))


def _same_run(tree, high, g):
    """Whether a row and the one ``g`` places before it share MIN_DEPTH minima."""
    return (tree[g:] == tree[:-g]) & (high[g:] == high[:-g])


def _may_link(tree, high, n, component, g, percent):
    """Whether a row and the one ``g`` places before it are of one region, of two components and of fitting sizes."""
    small, large = np.minimum(n[g:], n[:-g]), np.maximum(n[g:], n[:-g])
    return _same_run(tree, high, g) & (component[g:] != component[:-g]) & (100 * small >= percent * large)


def _within_wide(scanned, nodes, window, percent):
    """Pairs (a, b) within ``window`` places in wide regions of several components, unlike signatures left out.

    Every row gets its signature once for each tree, however many candidates it has.
    What stands across a cut is left to the exact search, which covers these regions whole.
    """
    columns = ["tree", "high", "low", "id", "n", "component"]
    wide = scanned.where(F.col("kind") == WIDE).withColumnRenamed("a", "id").select(*columns).distinct()
    mixed = wide.groupBy("tree", "high").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rows = wide.join(mixed.select("tree", "high"), ["tree", "high"], "left_semi").join(nodes.select("id", "signature"), "id")
    order = ["tree", "high", "low", "id"]
    rows = rows.select(*columns, "signature").repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(i).to_numpy() for i in range(6)]
            new.append(np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint16).reshape(batch.num_rows, -1))
            old = len(held[0]) if held else 0
            tree, high, _, ids, n, component, signature = all_ = [np.concatenate(x) for x in zip(held, new)] if held else new
            for g in range(1, min(window, len(ids) - 1) + 1):
                fit = _may_link(tree, high, n, component, g, percent) & (np.arange(g, len(ids)) >= old)
                at = np.flatnonzero(fit)
                at = at[_signatures_fit(signature[at], signature[at + g], percent)]
                a, b = ids[at], ids[at + g]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            held = [x[-window:] for x in all_]
        release()

    return rows.mapInArrow(run, "a long, b long")


def _signatures_fit(a, b, percent):
    """Whether the rows of two matrices of minima do not rule the threshold out."""
    least = percent / 100 - DEVIATIONS * math.sqrt(percent / 100 * (1 - percent / 100) / a.shape[1])
    return (a == b).mean(axis=1) >= least


def _candidates(a, b):
    none = pa.nulls(len(a), pa.int64())
    small = pa.nulls(len(a), pa.int32())
    kind = pa.array(np.full(len(a), PAIR, np.int32))
    columns = [kind, pa.array(a), pa.array(b), small, none, none, none, none, small]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _SCAN.split(", ")])


def _rows(kind, columns, part):
    tree, high, low, ids, n, component = columns
    full = lambda x: pa.array(np.full(len(ids), x, np.int32))
    arrays = [full(kind), pa.array(ids), pa.nulls(len(ids), pa.int64()), pa.array(tree), pa.array(high), pa.array(low), pa.array(n), pa.array(component), full(part)]
    return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in _SCAN.split(", ")])


def _across_cuts(scanned, window, percent):
    """Candidates among the rows next to cuts: a few of each partition, again in order."""
    edges = scanned.where(F.col("kind") == EDGE).drop("kind", "b").distinct()
    order = Window.partitionBy("tree", "high").orderBy("low", "a", "part")
    before = [F.lag(F.struct("a", "n", "component", "part"), g).over(order) for g in range(1, window + 1)]
    pairs = edges.select("a", "n", "component", "part", F.array(*before).alias("others"))
    pairs = pairs.select("a", "n", "component", "part", F.explode("others").alias("o")).where(
        (F.col("o.part") != F.col("part"))
        & (F.col("o.component") != F.col("component"))
        & (100 * F.least("n", "o.n") >= percent * F.greatest("n", "o.n"))
    )
    return pairs.select(F.least("a", "o.a").alias("a"), F.greatest("a", "o.a").alias("b"))


def _few(ids):
    """The ids, to be broadcast if they are few."""
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def _sets(docs, wanted, shingle, id_column, text_column):
    """(id, set): the sorted shingle hashes of the classes in ``wanted`` (id, doc): one row each.

    A class's document is read again; where its id is reused, the text that has the class's set counts.
    """
    wanted = materialize(wanted.distinct())
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    texts = texts.join(_few(wanted.select("doc").distinct()), "doc", "left_semi")

    def run(batches):
        for batch in batches:
            for a, b, hashes, offsets in _sets_by_chunk(batch.column(0), shingle):
                sets = [hashes[i:j].tobytes() for i, j in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_stands_for(hashes, offsets, 0)), pa.array(sets, pa.binary())], names=["id", "set"]
                )
        release()

    found = texts.select("text").mapInArrow(run, "id long, set binary")
    return materialize(found.join(_few(wanted.select("id")), "id", "left_semi").dropDuplicates(["id"]))


def _both(pairs, table, value):
    """``pairs`` with the ``value`` of either side."""
    for side in ("a", "b"):
        own = table.select(F.col("id").alias(side), F.col(value).alias(f"{value}_{side}"))
        pairs = pairs.join(own, side)
    return pairs.select("a", "b", f"{value}_a", f"{value}_b")


def _alike(pairs, nodes, percent):
    """Pairs whose signatures do not rule the threshold out."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array(_signatures_fit(a, b, percent)))
        release()

    return _both(pairs, nodes, "signature").mapInArrow(run, "a long, b long")


def _linked(pairs, sets, percent):
    """Pairs whose whole sets reach the threshold: 100 * intersection >= percent * union."""

    def run(batches):
        for batch in batches:
            fit = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                fit.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(fit, pa.bool_()))
        release()

    return _both(pairs, sets, "set").mapInArrow(run, "a long, b long")


def _rest(docs, scanned, labels, readers, shingle, percent, id_column, text_column):
    """Links that the windows left out: in wide regions of several components, by whole sets.

    Rows outside a region's largest component are compared with all its rows,
    in blocks of BLOCK by BLOCK rows, so a task holds a bounded part of a
    region; of a row's links to one component in a block, one comes out.
    """
    rows = _relabelled(scanned, labels)
    edges = rows.where(F.col("kind") == EDGE)
    cut = edges.groupBy("tree", "high").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y")
    columns = ["tree", "high", "a", "n", "component"]
    wide = rows.where(F.col("kind") == WIDE).select(*columns)
    wide = wide.unionByName(edges.join(cut, ["tree", "high"], "left_semi").select(*columns)).distinct()
    sizes = wide.groupBy("tree", "high", "component").agg(F.count("*").alias("k"))
    regions = (
        sizes.groupBy("tree", "high")
        .agg(F.sum("k").alias("rows"), F.max(F.struct("k", "component")).alias("top"), F.count("*").alias("components"))
        .where("components > 1")
        .select("tree", "high", F.col("top.component").alias("main"), (F.col("rows") - F.col("top.k")).alias("strays"), "rows")
    )
    mixed = materialize(wide.join(regions, ["tree", "high"]).withColumnRenamed("a", "id"))
    if mixed.isEmpty():
        return None
    sets = _sets(docs, readers.join(mixed.select("id").distinct(), "id", "left_semi"), shingle, id_column, text_column)
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), blocks(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("id"), blocks(c)).cast("int")
    keep = ["tree", "high", "s", "r", "id", "component"]
    strays = mixed.where("component <> main").withColumn("s", own("strays")).withColumn("r", every("rows"))
    others = mixed.withColumn("r", own("rows")).withColumn("s", every("strays"))
    strays, others = (x.select(*keep).join(sets, "id") for x in (strays, others))
    others = others.select(*[F.col(c).alias(c) for c in others.columns])  # columns of its own

    def compare(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        (ids, parts, n, x), (others, their, m, y) = _dense(left, right)
        both = x @ y.T
        fit = (100 * both >= percent * (n[:, None] + m[None, :] - both)) & (parts[:, None] != their[None, :])
        at, to = np.nonzero(fit)
        _, first = np.unique(np.stack([at, their[to]]), axis=1, return_index=True)
        at, to = ids[at[first]], others[to[first]]
        return pa.table({"a": pa.array(np.minimum(at, to)), "b": pa.array(np.maximum(at, to))})

    key = ["tree", "high", "s", "r"]
    found = strays.groupBy(*key).cogroup(others.groupBy(*key)).applyInArrow(compare, "a long, b long")
    return materialize(found.distinct())


def _dense(left, right):
    """(ids, components, sizes, 0/1 matrix over the shingles that both sides have) of either side."""
    sides = []
    for table in (left, right):
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("set").combine_chunks()]
        sides.append((table.column("id").to_numpy(), table.column("component").to_numpy(), sets))
    flat = [np.concatenate(sets) for *_, sets in sides]
    common = np.intersect1d(*flat)
    out = []
    for (ids, component, sets), tokens in zip(sides, flat):
        sizes = np.array([len(s) for s in sets])
        row = np.repeat(np.arange(len(sets)), sizes)
        at = np.searchsorted(common, tokens)
        has = (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == tokens) if len(common) else np.zeros(len(tokens), bool)
        matrix = np.zeros((len(sets), len(common)), np.float32)
        matrix[row[has], at[has]] = 1
        out.append((ids, component, sizes, matrix))
    return out


def near_copies(docs, shingle=5, percent=80, id_column="doc_id", text_column="text"):
    """doc_id, n_shingles, component_id and kept for each row of ``docs``, with text_key (a hash of
    the text) and component_key, which tells components apart that begin with the same reused id.

    Two documents are linked if their sets of distinct shingles of ``shingle``
    words (see ``words``) have 100 * intersection >= ``percent`` * union; a text
    of fewer words is one shingle. ``component_id`` is the smallest id that
    links reach, ``kept`` marks the document that has it.

    Defined results: null or empty texts and texts of white space have no
    shingles and are linked with nothing; rows with a null id are no documents:
    they keep a null component and are kept. Repeated rows come out repeated;
    rows that repeat an id with other texts go by their own texts. Other
    columns are ignored; an empty table gives no rows. Whole texts count.

    A pair at the threshold is found but for a chance of MISS in the forest;
    what the window leaves out is searched exactly.
    """
    trees = trees_for(percent)
    sketched = materialize(sketch(docs, shingle, trees, id_column, text_column))
    rows = sketched.where("doc_id is not null and n_shingles > 0")
    # A class is known by 64 bits of its set, not by a document: an id may come with several texts.
    sets = ["set_a", "set_b", "n_shingles"]
    classes = materialize(rows.groupBy(*sets).agg(F.min("doc_id").alias("doc_id")))
    readers = classes.select(F.col("set_a").alias("id"), F.col("doc_id").alias("doc"))
    nodes = materialize(
        rows.join(classes, [*sets, "doc_id"], "left_semi")
        .select(F.col("set_a").alias("id"), F.col("n_shingles").alias("n"), "signature")
        .dropDuplicates(["id"])
    )
    labels = None
    for window, used, last in ((1, min(FIRST, trees), False), (1, trees, False), (WINDOW, trees, True)):
        labelled = nodes.withColumn("component", F.col("id")) if labels is None else _labelled(nodes, labels)
        scanned = _scan(labelled, used, window, percent, not last)
        pairs = scanned.where(F.col("kind") == PAIR).select("a", "b")
        pairs = pairs.unionByName(_across_cuts(scanned, window, percent)).distinct()
        alike = _alike(pairs, nodes, percent)
        if last:
            alike = alike.unionByName(_within_wide(scanned, nodes, window, percent)).distinct()
        alike = materialize(alike)
        labels = _merged(labels, _confirmed(docs, alike, readers, shingle, percent, id_column, text_column))
    if not scanned.where(F.col("kind") == WIDE).isEmpty():
        rest = _rest(docs, scanned, labels, readers, shingle, percent, id_column, text_column)
        if rest is not None:
            labels = _merged(labels, rest)
    labelled = _labelled(readers, labels)
    least = labelled.groupBy("component").agg(F.min("doc").alias("component_id"))
    labelled = labelled.join(least, "component").select(
        F.col("id").alias("set_a"), "component_id", F.col("component").alias("component_key")
    )
    out = ["doc_id", "n_shingles", "component_id", "text_key", "component_key"]
    found = rows.join(labelled, "set_a").select(*out)
    alone = sketched.where("doc_id is null or n_shingles = 0")
    alone = alone.withColumns({"component_id": F.col("doc_id"), "component_key": F.col("text_key")}).select(*out)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.unionByName(alone).select(*out[:3], kept, *out[3:])


def _confirmed(docs, alike, readers, shingle, percent, id_column, text_column):
    ids = alike.select(F.col("a").alias("id")).unionByName(alike.select(F.col("b").alias("id"))).distinct()
    sets = _sets(docs, readers.join(_few(materialize(ids)), "id", "left_semi"), shingle, id_column, text_column)
    return materialize(_linked(alike, sets, percent))


def _merged(labels, links):
    """(id, component_id) once ``links`` are added to what ``labels`` already join.

    Only the links between components are followed, so a large group costs its links once.
    """
    if labels is None:
        return materialize(components(links))
    ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).distinct()
    known = ends.join(labels, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    known = materialize(known)
    side = lambda c: known.select(F.col("id").alias(c), F.col("component_id").alias(f"component_{c}"))
    between = links.join(side("a"), "a").join(side("b"), "b")
    between = between.select(F.col("component_a").alias("a"), F.col("component_b").alias("b")).distinct()
    joined = materialize(components(between)).withColumnRenamed("component_id", "now")
    old = labels.unionByName(known.join(labels.select("id"), "id", "left_anti"))
    old = old.join(joined.withColumnRenamed("id", "component_id"), "component_id", "left")
    return materialize(old.select("id", F.coalesce("now", "component_id").alias("component_id")))


def _labelled(nodes, labels):
    """``nodes`` with the component of each, itself where nothing is linked."""
    known = labels.select("id", F.col("component_id").alias("component"))
    return nodes.drop("component").join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _relabelled(scanned, labels):
    known = labels.select(F.col("id").alias("a"), F.col("component_id").alias("now"))
    rows = scanned.where(F.col("kind") != PAIR).drop("component").join(known, "a", "left")
    return rows.withColumn("component", F.coalesce("now", "a")).drop("now")
