"""Line dedup: lines that many documents hold stay in one of them.

Hashes of lines are partitioned by range and sorted by document and position;
a pass over each partition meets the first occurrence of a line first. What
comes back is one compressed bitmap per document that tells its lines to keep.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from rinkflow.llm.workers import ship
from rinkflow.session import materialize

LEAST_POINTS = 40
LEAST_DOCUMENTS = 5

_SPACE = b" \t\n\v\f\r"
#: A streamed row: a line to drop, a line of a run at a partition's edge, or what is known of such a run.
DROP, EDGE, RUN = 0, 1, 2


def line_key(line):
    """The bytes that equal lines share: white space at both ends gone, A-Z lower-cased."""
    return line.strip(_SPACE).lower()


def _points(key):
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _lines(batches, least_points):
    """id, text key, number of lines, and the hashes and places of lines that may be dropped."""
    for batch in batches:
        n_lines, ends, places, digests = [], [0], [], []
        for text in batch.column(2):
            lines = (text.as_py() or b"").split(b"\n")
            n_lines.append(len(lines))
            for place, line in enumerate(lines):
                if len(line) >= least_points:
                    key = line_key(line)
                    if len(key) >= least_points and _points(key) >= least_points:
                        places.append(place)
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
            ends.append(len(places))
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        each = pa.StructArray.from_arrays(
            [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(places, pa.int64())], ["h1", "h2", "place"]
        )
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(n_lines, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)],
            names=["id", "text_key", "n_lines", "lines"],
        )


class _Runs:
    """First occurrences along rows sorted by hash, then id downwards.

    A run is all rows of one hash. It is decided once ``least`` documents of it
    have been met; the rows of fewer documents than that wait. The first and
    the last run of a partition may go on in its neighbours: their rows come
    out as EDGE rows (those of the last one as DROP rows if it is decided here,
    as it starts here), with one RUN row each.
    """

    def __init__(self, least):
        self.least = least
        self.waiting = None
        self.open = None  # [h1, h2, first id, documents, last id] of a run whose rows have gone out
        self.at_edge = True  # whether the open or waiting run is the partition's first

    def _out(self, kind, rows, docs=0):
        n = len(rows["id"])
        return pa.RecordBatch.from_pydict(
            {"kind": np.full(n, kind, np.int32), **{c: rows[c] for c in ("h1", "h2", "id", "text_key", "place")},
             "docs": np.full(n, docs, np.int64)}
        )

    def _run(self):
        h1, h2, first, docs, _ = self.open
        one = lambda v: np.array([v], np.int64)
        rows = {"h1": one(h1), "h2": one(h2), "id": one(first), "text_key": one(0), "place": one(0)}
        return self._out(RUN, rows, docs)

    def _begin(self, rows):
        ids = rows["id"]
        docs = 1 + int((ids[1:] != ids[:-1]).sum())
        self.open = [rows["h1"][0], rows["h2"][0], ids[0], docs, ids[-1]]

    def _go_on(self, rows):
        ids = rows["id"]
        self.open[3] += int(ids[0] != self.open[4]) + int((ids[1:] != ids[:-1]).sum())
        self.open[4] = ids[-1]

    def _emit(self, rows):
        if self.at_edge:
            return self._out(EDGE, rows)
        later = rows["id"] != self.open[2]
        return self._out(DROP, {c: v[later] for c, v in rows.items()})

    def feed(self, rows):
        if self.waiting is not None:
            rows = {c: np.concatenate([self.waiting[c], v]) for c, v in rows.items()}
            self.waiting = None
        n = len(rows["id"])
        if not n:
            return
        part = lambda a, b: {c: v[a:b] for c, v in rows.items()}
        h1, h2, ids = rows["h1"], rows["h2"], rows["id"]
        new_run = np.ones(n, bool)
        new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        begins = np.append(np.flatnonzero(new_run), n)
        at = 0
        if self.open is not None:
            if (h1[0], h2[0]) == (self.open[0], self.open[1]):
                self._go_on(part(0, begins[1]))
                yield self._emit(part(0, begins[1]))
                at = 1
            if at < len(begins) - 1:
                if self.at_edge:
                    yield self._run()
                self.open, self.at_edge = None, False
        elif self.at_edge:
            # The partition's first run goes out as it comes.
            self._begin(part(0, begins[1]))
            yield self._emit(part(0, begins[1]))
            at = 1
            if at < len(begins) - 1:
                yield self._run()
                self.open, self.at_edge = None, False
        if at >= len(begins) - 1:
            return
        # Whole runs but the last, all at once.
        a, b = begins[at], begins[-2]
        if a < b:
            heads = begins[at:-1][:-1] - a
            new_doc = np.ones(b - a, bool)
            new_doc[1:] = ids[a + 1 : b] != ids[a : b - 1]
            new_doc |= new_run[a:b]
            docs = np.add.reduceat(new_doc.astype(np.int64), heads)
            sizes = np.diff(np.append(heads, b - a))
            later = np.repeat(docs >= self.least, sizes) & (ids[a:b] != np.repeat(ids[a:b][heads], sizes))
            if later.any():
                yield self._out(DROP, {c: v[a:b][later] for c, v in rows.items()})
        last = part(b, n)
        if 1 + int((last["id"][1:] != last["id"][:-1]).sum()) >= self.least:
            self._begin(last)
            yield self._emit(last)
        else:
            self.waiting = last

    def end(self):
        if self.waiting is not None:
            self._begin(self.waiting)
            yield self._out(EDGE, self.waiting)
        if self.open is not None:
            yield self._run()


def _first_occurrences(batches, least):
    runs = _Runs(least)
    for batch in batches:
        yield from runs.feed({c: batch.column(c).to_numpy() for c in batch.schema.names})
    yield from runs.end()


def pack(n_lines, dropped):
    """The compressed bitmap of the lines to keep, or None if all stay."""
    if not len(dropped):
        return None
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def unpack(packed, n_lines):
    """The lines to keep as booleans."""
    if packed is None:
        return np.ones(n_lines, bool)
    bits = np.frombuffer(zlib.decompress(packed), np.uint8)
    return np.unpackbits(bits, bitorder="little")[:n_lines].astype(bool)


def _maps(batches):
    for batch in batches:
        n_lines = batch.column(2).to_pylist()
        dropped = [x or [] for x in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array([len(x) for x in dropped], pa.int64()),
                pa.array([pack(n, x) for n, x in zip(n_lines, dropped)], pa.binary()),
            ],
            names=["id", "text_key", "n_lines", "n_dropped", "keep"],
        )


def keep_maps(docs, id_column="doc_id", text_column="text", least_points=LEAST_POINTS, least_documents=LEAST_DOCUMENTS):
    """Per document: id, text_key (a hash of its text), n_lines, n_dropped and keep.

    A line's key is the line without white space at its ends and with A-Z
    lower-cased. Lines with a key of at least ``least_points`` code points that
    is found under at least ``least_documents`` ids are dropped, but for those
    of the largest id. ``keep`` is a compressed bitmap of the other lines (see
    `unpack`), null if nothing is dropped.

    The range partitions are cut by hash and id, so a line that a third of all
    documents hold spreads over many tasks; what the runs at their edges hold in
    all is known from two rows a partition.

    A null or empty text is one empty line. A row without an id loses nothing
    and counts for nothing. Rows that share an id count as one document, each
    with lines of its own. An empty table gives no rows. Other columns are
    ignored.
    """
    ship(docs.sparkSession)
    text = F.col(text_column).cast("binary")
    kept = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    lines = kept.mapInArrow(
        lambda batches: _lines(batches, least_points),
        "id long, text_key long, n_lines long, lines array<struct<h1:long,h2:long,place:long>>",
    )
    lines = materialize(lines)
    spots = lines.where("id is not null").select("id", "text_key", F.inline("lines"))
    spots = spots.repartitionByRange("h1", "h2", F.desc("id"))
    spots = spots.sortWithinPartitions("h1", "h2", F.desc("id"), "text_key", "place")
    marks = spots.select("h1", "h2", "id", "text_key", "place").mapInArrow(
        lambda batches: _first_occurrences(batches, least_documents),
        "kind int, h1 long, h2 long, id long, text_key long, place long, docs long",
    )
    marks = materialize(marks)
    runs = marks.where(F.col("kind") == RUN).groupBy("h1", "h2").agg(F.max("id").alias("largest"), F.sum("docs").alias("docs"))
    runs = runs.where(F.col("docs") >= least_documents).drop("docs")
    # At most two rows for each range partition.
    at_edges = marks.where(F.col("kind") == EDGE).join(F.broadcast(runs), ["h1", "h2"]).where("id < largest")
    place = ["id", "text_key", "place"]
    dropped = marks.where(F.col("kind") == DROP).select(*place).unionByName(at_edges.select(*place))
    dropped = dropped.groupBy("id", "text_key").agg(F.collect_set("place").alias("dropped"))
    heads = lines.select("id", "text_key", "n_lines").join(dropped, ["id", "text_key"], "left")
    return heads.mapInArrow(_maps, "id long, text_key long, n_lines long, n_dropped long, keep binary")


def _kept_text(batches):
    for batch in batches:
        texts = []
        for text, n_lines, packed in zip(*(batch.column(c).to_pylist() for c in ("text", "n_lines", "keep"))):
            text = text or b""
            if packed is not None:
                keep = unpack(packed, n_lines)
                text = b"\n".join(line for line, stays in zip(text.split(b"\n"), keep) if stays)
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("n_lines"), batch.column("n_dropped"), pc.cast(pa.array(texts, pa.binary()), pa.string())],
            names=["id", "n_lines", "n_dropped", "text"],
        )


def apply_maps(docs, maps, id_column="doc_id", text_column="text"):
    """Each document's id, n_lines, n_dropped and text: the lines that its map keeps, joined by \\n.

    Maps meet documents by id and text. Documents without a map keep all lines;
    a null text gives an empty one.
    """
    text = F.col(text_column).cast("binary")
    docs = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    maps = maps.where("keep is not null").dropDuplicates(["id", "text_key"])
    lines = F.coalesce(F.octet_length("text") - F.octet_length(F.expr("replace(cast(text as string), '\n', '')")) + 1, F.lit(1))
    found = docs.join(maps.drop("n_lines"), ["id", "text_key"], "left").select(
        "id", "text", lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep"
    )
    return found.mapInArrow(
        _kept_text, f"id {docs.schema['id'].dataType.simpleString()}, n_lines long, n_dropped long, text string"
    ).withColumnRenamed("id", id_column)
