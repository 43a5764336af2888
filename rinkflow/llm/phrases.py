"""Phrase collocations from a weighted de Bruijn graph of the words of each language.

The nodes are the phrases of ``longest - 1`` words, the edges those of
``longest`` words, from the node of their first words to that of their last.
Only edges are counted in the texts, and the ends of pieces, where fewer words
are left. A node's count is what flows out of it and what ends there; a shorter
phrase's count is that of the longer ones that begin with it and what ends
there.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rinkflow.llm import spans as S
from rinkflow.llm import words as W
from rinkflow.llm.workers import ship
from rinkflow.session import materialize

LEAST_COUNT = 10
LONGEST = 3
TOP = 2000
#: A phrase goes if a longer one around it has this percentage of its count.
SWALLOWED_PERCENT = 50
#: Bytes of text whose grams are counted together before they are shuffled.
BLOCK = 4 << 20
#: Buckets of nodes: a block sends at most one row to each, whatever the number of tasks.
BUCKETS = 1 << 14
#: Bytes of text per task that adds counts up; beyond MOST_TASKS tasks get larger and spill.
TEXT_PER_TASK = 8 << 20
MOST_TASKS = BUCKETS

_BREAKS = b".,;:!?\n\v\f\r"
_MACHINE = S.Machine(apart=b" \t" + _BREAKS, symbols=_BREAKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words_as_strings(data, starts, lengths):
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at])]
    return pa.StringArray.from_buffers(len(starts), *buffers[1:])


def _block_grams(data, offsets, langs, longest, buckets):
    """(language, bucket, lines) of a block of texts; see `_grams`."""
    data = _LOWER[data]
    said = _MACHINE.run(data, offsets)
    starts, lengths, row = _MACHINE.words(data, offsets, said)
    if not len(starts):
        return
    table = S.Table(data, starts, lengths, langs[row])
    owners, word = table.entries()
    strings = _words_as_strings(data, starts[owners], lengths[owners])
    hashes, lang_of = table.hashes[owners], langs[row[owners]]
    # The word after a word is 0 at the end of a piece, else its number + 1.
    broken = np.searchsorted(np.flatnonzero(said & S.SYMBOL), starts)
    follows = (row[1:] == row[:-1]) & (broken[1:] == broken[:-1])
    n = len(word)
    left = np.zeros(n, np.int64)  # words left in the piece, up to `longest`
    for k in range(1, longest):
        reach = np.zeros(n, bool)
        reach[:-1] = follows & (left[1:] >= k - 1)
        left[reach] = k
    padded = np.append(word + 1, np.zeros(longest, np.int64))
    after = lambda k: np.where(left >= k, padded[k : k + n], 0)
    del table, said, starts, lengths, row, broken, follows
    base = len(owners) + 1
    words = lambda number: strings.take(pa.array(number - 1, mask=number == 0))
    key, texts, lang, marks = word, strings, lang_of, hashes
    for k in range(1, longest - 1):
        pairs, key = np.unique(key * base + after(k), return_inverse=True)
        before, number = pairs // base, pairs % base
        texts = pc.binary_join_element_wise(texts.take(pa.array(before)), words(number), " ", null_handling="skip")
        lang = lang[before]
        with np.errstate(over="ignore"):
            marks = W.mix(marks[before] + np.where(number > 0, hashes[number - 1], np.uint64(k)))
    edges, counts = np.unique(key * base + after(longest - 1), return_counts=True)
    node, number = edges // base, edges % base
    # One bucket holds all that is counted of a node.
    bucket = (marks[node] % np.uint64(buckets)).astype(np.int64)
    place = lang[node] * buckets + bucket
    order = np.argsort(place, kind="stable")
    node, number, counts, place = node[order], number[order], counts[order], place[order]
    lines = pc.binary_join_element_wise(texts.take(pa.array(node)), pc.fill_null(words(number), ""), "\r")
    times = pa.array(counts, mask=counts == 1).cast(pa.string())
    lines = pc.binary_join_element_wise(lines, times, "\t", null_handling="skip")
    begins = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    each = pa.ListArray.from_arrays(pa.array(np.append(begins, len(place)), pa.int32()), lines)
    yield pa.array(place[begins] // buckets), pa.array(place[begins] % buckets), pc.binary_join(each, "\n")


def _cuts(data, most):
    """Offsets that cut one long text after breaks into parts of about ``most`` bytes; no phrase spans a break."""
    breaks = np.flatnonzero(np.isin(data, np.frombuffer(_BREAKS, np.uint8))) + 1
    out = [0]
    while len(data) - out[-1] > most:
        i = np.searchsorted(breaks, out[-1] + most, "right") - 1
        if i < 0 or breaks[i] <= out[-1]:
            i += 1  # a piece beyond that size stays whole
        if i >= len(breaks) or breaks[i] >= len(data):
            break
        out.append(int(breaks[i]))
    return [*out, len(data)]


def _grams(batches, longest, buckets, most=BLOCK):
    """Rows (lang, bucket, lines): what follows the nodes of a block of texts, and how often.

    A line is a node, a carriage return and the next word, then a tab and the
    number if that is not 1. The next word is empty where the piece ends, and
    only there a node has fewer words. Lines of one node are next to each
    other, and those of one first word: they compress well.
    """
    for batch in batches:
        names = pc.fill_null(batch.column(0), "und").dictionary_encode()
        langs = names.indices.to_numpy().astype(np.int64)
        for a, b in W.chunks(batch.column(1), most):
            data, offsets = W.column_bytes(batch.column(1).slice(a, b - a))
            parts = [(data, offsets, langs[a:b])]
            if b - a == 1 and len(data) > most:
                cuts = _cuts(data, most)
                parts = [(data[x:y], np.array([0, y - x]), langs[a:b]) for x, y in zip(cuts, cuts[1:])]
            for part in parts:
                for lang, bucket, lines in _block_grams(*part, longest, buckets):
                    found = pa.RecordBatch.from_arrays(
                        [names.dictionary.take(lang), bucket, lines], names=["lang", "bucket", "lines"]
                    )
                    for at in range(0, found.num_rows, 512):
                        yield found.slice(at, 512)


def _size(gram):
    return F.size(F.split(gram, " "))


def _but_last(gram):
    return F.expr(f"substring_index({gram}, ' ', size(split({gram}, ' ')) - 1)")


def _but_first(gram):
    return F.expr(f"substr({gram}, instr({gram}, ' ') + 1)")


def _edges(docs, text_column, lang_column, longest, least):
    """(lang, gram, next, n): frequent edges with their next word; all other occurrences without.

    Those of a node below ``least`` are handed to the node's first words, as
    only shorter phrases can need them. So every occurrence of a word is in
    exactly one row that its phrase begins.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, size // TEXT_PER_TASK + 1))
    rows = kept.mapInArrow(lambda batches: _grams(batches, longest, BUCKETS), "lang string, bucket long, lines string")
    rows = rows.repartition(tasks, "bucket").select("lang", "bucket", F.explode(F.split("lines", "\n")).alias("line"))
    rest = F.substring_index("line", "\r", -1)
    times = F.when(F.contains(rest, F.lit("\t")), F.substring_index(rest, "\t", -1).cast("long")).otherwise(1)
    node = ["bucket", "lang", "node"]
    edges = rows.select("lang", "bucket", F.substring_index("line", "\r", 1).alias("node"), F.substring_index(rest, "\t", 1).alias("next"), times.alias("n"))
    edges = edges.groupBy(*node, "next").agg(F.sum("n").alias("n"))
    frequent = (F.col("next") != "") & (F.col("n") >= least)
    flow = edges.groupBy(*node, F.when(frequent, F.col("next")).alias("next")).agg(F.sum("n").alias("n"))
    flow = flow.withColumn("f", F.sum("n").over(Window.partitionBy(*node)))
    gram = F.col("node")
    if longest > 2:
        rare = (_size("node") == longest - 1) & (F.col("f") < least)
        gram = F.when(rare, _but_last("node")).otherwise(gram)
    return flow.groupBy("lang", gram.alias("gram"), "next").agg(F.sum("n").alias("n"))


class Graph:
    """``counts`` (lang, gram, size, n) of all phrases of at least ``least`` occurrences,
    ``totals`` (lang, n) and ``links`` between edges that follow each other without a branch."""

    def __init__(self, docs, text_column="text", lang_column="lang", longest=LONGEST, least=LEAST_COUNT):
        if longest < 2:
            raise ValueError("phrases have at least two words")
        self.longest, self.least = longest, least
        edges = materialize(_edges(docs, text_column, lang_column, longest, least))
        whole = F.concat_ws(" ", "gram", "next").alias("gram")
        longer = edges.where("next is not null").select("lang", whole, "n")
        levels = [longer.withColumn("size", F.lit(longest))]
        ended = edges.select("lang", "gram", "n", _size("gram").alias("size"))
        flow = None
        for size in range(longest - 1, 0, -1):
            rows = ended.where(F.col("size") == size).drop("size")
            if flow is not None:
                rows = rows.unionByName(flow)
            level = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
            levels.append(level.where(F.col("n") >= least).withColumn("size", F.lit(size)))
            if size > 1:
                flow = level.select("lang", _but_last("gram").alias("gram"), "n")
        counts = levels[0]
        for level in levels[1:]:
            counts = counts.unionByName(level)
        self.counts = materialize(counts.select("lang", "gram", "size", "n"))
        self.totals = edges.groupBy("lang").agg(F.sum("n").alias("n"))
        self.links = self._links()

    def edges(self):
        return self.counts.where(F.col("size") == self.longest)

    def _links(self):
        """(lang, gram, node, to): edges in and out of a node that all its occurrences pass.

        The node then has no other edge, and no piece begins or ends there.
        """
        nodes = self.counts.where(F.col("size") == self.longest - 1).select("lang", F.col("gram").alias("node"), "n")
        into = self.edges().select("lang", "gram", _but_first("gram").alias("node"), "n")
        out = self.edges().select("lang", F.col("gram").alias("to"), _but_last("gram").alias("node"), "n")
        keys = ["lang", "node", "n"]
        found = into.join(nodes, keys).join(out.join(nodes, keys), keys)
        return materialize(found.select("lang", "gram", "node", "to"))

    def paths(self):
        """(lang, gram, path): the edges on unary paths, each with the words of its whole path.

        Every edge learns its path's last edge and how far it is, twice as far
        in each round; a path is no longer than a piece of a text. Edges off
        such paths have no row.
        """
        hops = self.links.select("lang", "gram", "to", F.lit(1).cast("long").alias("hops"))
        while True:
            further = hops.select("lang", F.col("gram").alias("to"), F.col("to").alias("beyond"), F.col("hops").alias("more"))
            joined = materialize(hops.join(further, ["lang", "to"], "left"))
            hops = joined.select(
                "lang",
                "gram",
                F.coalesce("beyond", "to").alias("to"),
                (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            )
            if joined.where("beyond is not null").isEmpty():
                break
        ends = hops.select("lang", F.col("to").alias("gram"), "to", F.lit(0).cast("long").alias("hops")).distinct()
        hops = hops.unionByName(ends)
        steps = F.sort_array(F.collect_list(F.struct("hops", "gram")), asc=False)
        last_words = F.transform(F.col("steps"), lambda s: F.substring_index(s["gram"], " ", -1))
        paths = hops.groupBy("lang", "to").agg(steps.alias("steps"))
        path = F.concat_ws(" ", _but_last("steps[0].gram"), F.array_join(last_words, " "))
        return paths.select("lang", F.explode("steps.gram").alias("gram"), path.alias("path"))


def collocations(
    docs, text_column="text", lang_column="lang", longest=LONGEST, least=LEAST_COUNT, percent=SWALLOWED_PERCENT, top=TOP
):
    """The first ``top`` phrases of each language by how their words hold together.

    Phrases of 2 to ``longest`` words with a >= ``least`` occurrences are cut
    after their first k words; with l and r occurrences of the two parts the
    score is floor(1000000 * a * a / (l * r)), and the lowest cut counts (ties:
    the smallest k). Phrases inside a longer one of at least ``percent`` of
    their occurrences are dropped. Returns lang, rank, phrase, a, l, r, n (words
    of the language), score and path: for a phrase of ``longest`` words the
    fixed wording around it, else itself. By score, a (both descending) and the
    phrase's bytes.

    Counts are exact up to 10^16 occurrences of a phrase. A null text is empty, a
    null language "und". Repeated rows count as often as they come; an empty
    table gives no rows. Other columns are ignored.
    """
    graph = Graph(docs, text_column, lang_column, longest, least)
    counts = graph.counts
    phrases = counts.where("size > 1")
    if percent <= 100:
        # What lies inside a unary path is always part of it.
        inside = graph.links.select("lang", F.col("node").alias("gram"))
        phrases = phrases.join(inside, ["lang", "gram"], "left_anti")
    words = F.split("gram", " ")
    part = lambda first, length: F.array_join(F.slice(words, first, length), " ")
    if longest > 2:
        shorter = F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: part(i, m)),
        )
        around = counts.where("size > 2").select("lang", "n", F.explode(F.flatten(shorter)).alias("gram"))
        around = around.groupBy("lang", "gram").agg(F.max("n").alias("around"))
        phrases = phrases.join(around, ["lang", "gram"], "left")
        phrases = phrases.where(F.coalesce(100 * F.col("around") < percent * F.col("n"), F.lit(True)))
    cuts = phrases.select("lang", "gram", F.col("n").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", part(F.lit(1), F.col("k"))).withColumn("right", part(F.col("k") + 1, F.col("size") - F.col("k")))
    of = lambda side, name: counts.select("lang", F.col("gram").alias(side), F.col("n").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    square = (F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a"))).alias("square")
    cuts = cuts.select("lang", "gram", "a", "l", "r", "k", square, (wide("l") * wide("r")).alias("product"))
    cuts = cuts.withColumn("score", F.expr("square div product"))
    best = cuts.groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", F.col("gram").alias("phrase"), "a", "best.l", "best.r", "best.score")
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    paths = graph.paths().withColumnRenamed("gram", "phrase")
    found = ranked.join(graph.totals, "lang").join(paths, ["lang", "phrase"], "left")
    return found.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")],
        F.coalesce("path", "phrase").alias("path"),
    )
