"""Filter interaction audit: what each order of five document filters removes, and why.

One finite-state pass over the bytes of a text gives all its counts; the rest
is arithmetic on the number of documents by the set of filters that they fail.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rinkflow.llm import spans as S
from rinkflow.llm import words as W
from rinkflow.llm.workers import ship

LEAST_WORDS = 100
LEAST_DISTINCT_PERCENT = 80
MOST_CAPITALS_PERCENT = 10
SYMBOLS = b"#$%&*|"
#: The filters, one bit each: few words, few distinct words, many capitals, symbols, copy of a smaller id.
FILTERS = "ABCDE"
COPY = 16
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]

_MACHINE = S.Machine(apart=b" \t\n\v\f\r", symbols=SYMBOLS)


def counts(column):
    """(words, distinct words, capitals, code points, symbols) of each text; nulls count as empty."""
    out = [np.zeros((5, 0), np.int64)]
    for a, b in W.chunks(column):
        data, offsets = W.column_bytes(column.slice(a, b - a))
        said = _MACHINE.run(data, offsets)
        starts, lengths, row = _MACHINE.words(data, offsets, said)
        owners, _ = S.Table(data, starts, lengths, row).entries()
        n = b - a
        out.append(
            np.stack(
                [
                    np.bincount(row, minlength=n),
                    np.bincount(row[owners], minlength=n),
                    S.per_text(said & S.CAPITAL, offsets),
                    np.diff(offsets) - S.per_text(said & S.CONTINUES, offsets),
                    S.per_text(said & S.SYMBOL, offsets),
                ]
            )
        )
    return np.concatenate(out, axis=1)


def fails(column):
    """The bits of the filters A to D that each text fails."""
    n, distinct, capitals, points, symbols = counts(column)
    flags = [
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT_PERCENT * n,
        100 * capitals > MOST_CAPITALS_PERCENT * points,
        symbols > 0,
    ]
    return sum(flag.astype(np.int32) << i for i, flag in enumerate(flags))


def measure(docs, id_column="doc_id", text_column="text", part_column="lang"):
    """(id, part, digest of the text, bits of the filters A to D that it fails) of each row."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    kept = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(part_column), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = pa.array(fails(batch.column(3)), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], names=["id", "part", "digest", "fails"])

    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, part string, digest binary, fails int")


def patterns(docs, labels, id_column="doc_id", text_column="text", part_column="lang"):
    """(part, fails, good, toxic, n): documents by the filters they fail and their labels.

    At most 128 rows a part. Copies add up before each shuffle: a text is known
    by its SHA-256, and per text only its smallest id and the rows that have it
    are kept.
    """
    rows = measure(docs, id_column, text_column, part_column)
    known = labels.groupBy(F.col(id_column).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    rows = rows.join(known, "id", "left").na.fill(False, ["good", "toxic"])
    kind = ["digest", "part", "fails", "good", "toxic"]
    rows = rows.groupBy("id", *kind).agg(F.count("*").alias("n"))
    texts = rows.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.min("id").alias("least"),
        F.min_by("n", "id").alias("at_least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
    )
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    texts = texts.withColumn("own", F.when(first, F.col("at_least")).otherwise(0) + F.col("without_id"))
    both = F.array(
        F.struct(F.col("fails"), F.col("own").alias("n")),
        F.struct(F.col("fails").bitwiseOR(COPY).alias("fails"), (F.col("n") - F.col("own")).alias("n")),
    )
    return (
        texts.select("part", "good", "toxic", F.inline(both))
        .groupBy("part", "fails", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def audit(docs, labels, id_column="doc_id", text_column="text", part_column="lang"):
    """One row per part, order of the filters (all 120) and step, with what the step does.

    ``kept`` documents after it; ``removed`` by it; ``redundant``: failing its
    filter but gone before; ``unique_fails``: failing its filter alone;
    ``good_lost``, ``toxic_lost``: removed ones with quality 1, toxic 1 in
    ``labels``; ``shapley``: removed by its filter, summed over all orders.

    A null text counts as empty, a null part as "". A row without an id is
    never a copy, nor one whose text is repeated under the same id; each row
    counts. Of labels repeated for an id any 1 counts. No documents give no
    rows. Other columns are ignored.
    """
    by_part = patterns(docs, labels, id_column, text_column, part_column).groupBy("part")
    sets = range(1 << len(FILTERS))
    passes = lambda failed: F.col("fails").bitwiseAND(failed) == 0
    total = lambda wanted: F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0))
    sums = by_part.agg(
        F.array(*[total(passes(s)) for s in sets]).alias("pass"),
        F.array(*[total(passes(s) & F.col("good")) for s in sets]).alias("good"),
        F.array(*[total(passes(s) & F.col("toxic")) for s in sets]).alias("bad"),
    )
    # A document is removed by a filter after a set of others if it passes those and fails this.
    n, everything = len(FILTERS), len(sets) - 1

    def shapley(bit):
        others = [s for s in sets if not s & bit]
        orders = {s: math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()) for s in others}
        return sum((orders[s] * (F.col("pass")[s] - F.col("pass")[s | bit]) for s in others), F.lit(0))

    sums = sums.withColumn("shapley", F.array(*[shapley(1 << i) for i in range(n)]))
    steps = sums.select("*", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    place = lambda at: F.instr(F.lit(FILTERS), F.col("filter_order").substr(at, F.lit(1))) - 1
    earlier = sum(
        (F.when(F.col("step") > i, F.call_function("shiftleft", F.lit(1), place(F.lit(i)))).otherwise(0) for i in range(1, n)),
        F.lit(0),
    )
    steps = steps.withColumn("at", place(F.col("step"))).withColumn("earlier", earlier)
    steps = steps.withColumn("bit", F.call_function("shiftleft", F.lit(1), F.col("at")))
    of = lambda name, failed: F.get(F.col(name), failed)
    after = F.col("earlier").bitwiseOR(F.col("bit"))
    lost = lambda name: of(name, F.col("earlier")) - of(name, after)
    return steps.select(
        "part",
        "filter_order",
        "step",
        of("pass", after).alias("kept"),
        lost("pass").alias("removed"),
        (of("pass", F.lit(0)) - of("pass", F.col("bit")) - lost("pass")).alias("redundant"),
        (of("pass", F.lit(everything) - F.col("bit")) - of("pass", F.lit(everything))).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("bad").alias("toxic_lost"),
        F.get("shapley", F.col("at")).alias("shapley"),
    )
