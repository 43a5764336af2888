"""Language ID: known words first, shorter and shorter character n-grams for unseen ones.

All counts count. They stay in stored tables; only the most frequent words are
broadcast, as a shortcut. Texts are read in blocks: a block adds up what the
broadcast words give each text and lists its other distinct words, which are
joined to the tables; the replies meet the block's sums again.
"""

import functools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkflow.llm.words import chunks
from rinkflow.llm.workers import release, ship
from rinkflow.session import materialize

LETTERS = re.compile(r"[^\W\d_]+")
#: Words that are broadcast at most, and their entries (words times languages); no result depends on it.
MAX_WORDS = 200_000
MAX_ENTRIES = 2_000_000
#: Bytes of text, and words to be looked up, that close a block.
BLOCK_BYTES = 20 << 20
BLOCK_WORDS = 350_000
ORDERS = (5, 4, 3, 2, 1)
_KNOWN = pa.schema(
    {"lang": pa.string(), "size": pa.int32(), "place": pa.int32(), "least": pa.float64(), "total": pa.float64()}.items()
)
#: Count, in the language with the most text, that any language gets for what only others have.
FLOOR = 0.05
#: Entries that a worker holds before it flushes counts.
HELD = 150_000
#: Words that make a decision as sure as it gets; more of them count by their mean.
ENOUGH = 30


def letter_words(text):
    return LETTERS.findall(text.lower())


def grams(word, order):
    """The character n-grams of a word with its bounds marked."""
    marked = f"<{word}>"
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def _rows(counts):
    """The counts of each language as rows; empties them."""
    langs = [lang for lang, items in counts.items() for _ in items]
    items = [item for items in counts.values() for item in items]
    n = [k for items in counts.values() for k in items.values()]
    counts.clear()
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(items, pa.string()), pa.array(n, pa.int64())],
        names=["lang", "item", "n"],
    )


def _counted(batches, items):
    """Counts of ``items`` of each text by language, flushed before they outgrow the worker."""
    counts = defaultdict(Counter)
    held = 0
    for batch in batches:
        for a, b in chunks(batch.column(1)):
            langs, texts = (batch.column(i).slice(a, b - a).to_pylist() for i in (0, 1))
            for lang, text in zip(langs, texts):
                own = counts[lang]
                held -= len(own)
                own.update(items(text))
                held += len(own)
                if held > HELD:
                    yield _rows(counts)
                    held = 0
    yield _rows(counts)
    release()


def _count_words(batches):
    return _counted(batches, letter_words)


def _count_grams(batches):
    """Each distinct word of a language counts once: unseen words are rare ones."""
    return _counted(batches, lambda word: [g for order in ORDERS for g in grams(word, order)])


def _weights(counts, totals, order):
    """item, place, weight of rows of (lang, item, n).

    A weight is the log frequency in the language with that place, less the
    one that all languages without the item have; totals are by language and
    n-gram length (0 for words), ``order`` is the column with the latter.
    """
    langs = sorted({lang for lang, _ in totals})
    most = Counter()
    for (_, o), n in totals.items():
        most[o] = max(most[o], n)
    spark = counts.sparkSession
    known = [
        {"lang": lang, "size": o, "place": langs.index(lang), "least": math.log(FLOOR / (most[o] + 1)), "total": float(n + 1)}
        for (lang, o), n in totals.items()
    ]
    # As Arrow: from plain rows Spark makes a table in Python workers of another kind, which then stay.
    known = spark.createDataFrame(pa.Table.from_pylist(known, schema=_KNOWN))
    weight = F.log((F.col("n") + F.lit(FLOOR)) / F.col("total")) - F.col("least")
    rows = counts.withColumn("size", order)
    return rows.join(F.broadcast(known), ["lang", "size"]).select("item", "place", weight.alias("weight"))


def _most_frequent(counts, most):
    """The items of the rows with at least the lowest count that leaves ``most`` rows or fewer."""
    by_count = sorted(counts.groupBy("n").count().collect(), reverse=True)
    cut, total = None, 0
    for n, rows in by_count:
        total += rows
        if total > most:
            break
        cut = n
    return counts.where(F.lit(False) if cut is None else F.col("n") >= cut).select("item").distinct()


class Frequent:
    """The broadcast part of a model: its languages, and the weights of frequent words."""

    def __init__(self, langs, rows):
        """``rows``: an Arrow table of (item, place, weight)."""
        self.langs = langs
        items = rows.column("item").combine_chunks().dictionary_encode()
        self.words = {item: i for i, item in enumerate(items.dictionary.to_pylist())}
        self.weights = np.zeros((len(self.words), len(langs)))
        place, weight = (rows.column(c).to_numpy() for c in ("place", "weight"))
        self.weights[items.indices.to_numpy(), place] = weight


class Model:
    """Weights by language: ``words`` and ``grams`` are tables of (item, place, weight)."""

    def __init__(self, spark, frequent, words, grams):
        self.spark, self.frequent, self.words, self.grams = spark, frequent, words, grams
        self.langs = frequent.langs

    def predict(self, texts):
        """(language, its share) of each text of a list."""
        rows = self.spark.createDataFrame(list(enumerate(texts)), "i long, text string")
        return [(r[1], r[2]) for r in identify(rows, self, ("i",)).orderBy("i").collect()]


def fit(docs, lang_column="lang", text_column="text"):
    """Word and n-gram frequencies by language over all rows with a language and a text.

    Counts are added up before and after a shuffle by item, and stored, all of
    them. Rows with null language or text teach nothing; repeated rows count as
    often as they come.
    """
    spark = docs.sparkSession
    ship(spark)
    schema = "lang string, item string, n long"
    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text"))
    counted = rows.where("lang is not null and text is not null").mapInArrow(_count_words, schema)
    counts = materialize(counted.groupBy("lang", "item").agg(F.sum("n").alias("n")))
    totals = {(r[0], 0): r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}
    gram_counts = counts.select("lang", "item").mapInArrow(_count_grams, schema)
    gram_counts = materialize(gram_counts.groupBy("lang", "item").agg(F.sum("n").alias("n")))
    gram_totals = {(r[0], r[1]): r[2] for r in gram_counts.groupBy("lang", F.length("item")).agg(F.sum("n")).collect()}
    words = _weights(counts, totals, F.lit(0))
    grams = _weights(gram_counts, gram_totals, F.length("item"))
    langs = sorted(lang for lang, _ in totals)
    most = _most_frequent(counts, min(MAX_WORDS, MAX_ENTRIES // max(1, len(langs))))
    frequent = Frequent(langs, words.join(F.broadcast(most), "item", "left_semi").toArrow())
    return Model(spark, frequent, words, grams)


class _Places(dict):
    """A word's place: the broadcast words', then the others' in the order they come."""

    def __missing__(self, word):
        self[word] = place = len(self)
        return place


class _Block:
    """Texts with the sums of their frequent words, and what else they hold."""

    def __init__(self, frequent, places):
        self.frequent, self.places = frequent, places
        self.parts, self.sums, self.sizes, self.rest, self.rests, self.bytes = [], [], [], [], [], 0

    def add(self, columns, texts, size):
        known = len(self.frequent.words)
        self.parts.append(columns)
        self.bytes += size
        for text in texts:
            words = [] if text is None else letter_words(text)
            at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
            seen = at < known
            self.sums.append(self.frequent.weights[at[seen]].sum(axis=0))
            rest = (at[~seen] - known).astype(np.int32)
            # -1: no language can be told.
            self.sizes.append(len(words) if text is not None and any(map(str.isalpha, text)) else -1)
            self.rest.append(rest)
            self.rests.append(len(rest))

    def full(self):
        return self.bytes >= BLOCK_BYTES or len(self.places) - len(self.frequent.words) >= BLOCK_WORDS

    def row(self, number):
        """The block as a row; forgets its words."""
        others = list(self.places)[len(self.frequent.words) :]
        for word in others:
            del self.places[word]
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(self.parts)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        numbers = pa.table({
            "size": pa.array(self.sizes, pa.int64()), "rests": pa.array(self.rests, pa.int64()),
            "sums": pa.array([x.tolist() for x in self.sums], pa.list_(pa.float64())),
            "rest": pa.array(self.rest, pa.list_(pa.int32())),
        })
        own = pa.BufferOutputStream()
        with pa.ipc.new_stream(own, numbers.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(numbers)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                pa.array([own.getvalue().to_pybytes()], pa.binary()), pa.array([others], pa.list_(pa.string())),
            ],
            names=["block", "kept", "numbers", "words"],
        )


def _blocks(held):
    def run(batches):
        frequent, number = held.value, TaskContext.get().partitionId() << 32
        places = _Places(frequent.words)
        block = _Block(frequent, places)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            names = batch.schema.names[:-1]
            for a, b in chunks(texts):
                columns = pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]], names=names)
                part = texts.slice(a, b - a)
                block.add(columns, part.to_pylist(), part.nbytes)
                if block.full():
                    yield block.row(number)
                    block, number = _Block(frequent, places), number + 1
                    release()
        if block.parts:
            yield block.row(number)
        del block, places
        release()

    return run


def _judge(langs):
    """(language, its share) for the texts of a block, from its row and the replies."""

    def run(blocks, replies):
        row = blocks.to_pylist()[0]
        kept = pa.ipc.open_stream(row["kept"]).read_all()
        numbers = pa.ipc.open_stream(row["numbers"]).read_all().combine_chunks()
        sizes, rests = (numbers.column(c).to_numpy() for c in ("size", "rests"))
        sums = np.array(numbers.column("sums").to_pylist(), float).reshape(len(sizes), len(langs))
        rest = numbers.column("rest").combine_chunks().flatten().to_numpy()
        weights = np.zeros((row["n"], len(langs)))
        at, place, weight = (replies.column(c).to_numpy() for c in ("at", "place", "weight"))
        weights[at, place] = weight
        starts = np.cumsum(rests) - rests
        some = rests > 0
        if langs and some.any():
            sums[some] += np.add.reduceat(weights[rest], starts[some])
        names, shares = np.full(len(sizes), "und", object), np.zeros(len(sizes))
        told = sizes >= 0
        if langs and told.any():
            total = sums[told] * np.minimum(1.0, ENOUGH / np.maximum(1, sizes[told]))[:, None]
            share = np.exp(total - total.max(axis=1, keepdims=True))
            best = np.argmax(total, axis=1)
            names[told] = np.array(langs, object)[best]
            shares[told] = share[np.arange(len(best)), best] / share.sum(axis=1)
        out = kept.append_column("lang_pred", pa.array(names, pa.string()))
        return out.append_column("score", pa.array(shares, pa.float64()))

    return run


def _unseen_weights(words, grams):
    """item, place, weight of words that no language has: the mean of their longest n-grams that some language has.

    Words without any give no row, which is a weight of 0 in every language.
    """
    marked = F.concat(F.lit("<"), F.col("item"), F.lit(">"))
    n = F.length(marked)

    def cut(order):
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), n - (order - 1)))
        every = F.transform(starts, lambda i: marked.substr(i, F.lit(order)))
        return F.when(n >= order, every).otherwise(F.array().cast("array<string>"))

    rest, found = materialize(words.select("item")), []
    for order in ORDERS:
        if found and rest.isEmpty():
            break
        rows = grams.where(F.length("item") == order).groupBy(F.col("item").alias("gram"))
        rows = rows.agg(F.collect_list(F.struct("place", "weight")).alias("own"))
        hits = rest.select("item", F.explode(cut(order)).alias("gram")).join(rows, "gram")
        hits = hits.groupBy("item").agg(F.count("*").alias("k"), F.flatten(F.collect_list("own")).alias("own"))
        means = hits.select("item", "k", F.inline("own")).groupBy("item", "place")
        found.append(materialize(means.agg((F.sum("weight") / F.first("k")).alias("weight"))))
        rest = materialize(rest.join(found[-1].select("item"), "item", "left_anti"))
    return functools.reduce(DataFrame.unionByName, found)


def identify(docs, model, columns=("doc_id",), text_column="text"):
    """``columns`` of each document with lang_pred and score (the language's share, 0 to 1).

    A text that is null or has no letter gets ``und`` and 0, so does every text
    under a model that learned nothing; equal shares go to the first language
    by name. Whole texts count. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model.frequent)
    kept = docs.select(*columns, F.col(text_column).alias("_text_"))
    schema = "block long, kept binary, numbers binary, words array<string>"
    blocks = materialize(kept.mapInArrow(_blocks(held), schema))
    asked = blocks.select("block", F.posexplode("words").alias("at", "item"))
    unseen = asked.select("item").distinct().join(model.words.select("item"), "item", "left_anti")
    weights = model.words.unionByName(_unseen_weights(unseen, model.grams))
    replies = asked.join(weights, "item").select(F.col("block").alias("to_block"), "at", "place", "weight")
    rows = blocks.select("block", "kept", "numbers", F.size("words").alias("n"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1])
    judged = rows.groupBy("block").cogroup(replies.groupBy("to_block"))
    return judged.applyInArrow(_judge(model.langs), f"{fields}, lang_pred string, score double")
