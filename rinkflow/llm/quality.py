"""Quality classifier: regularised quadratic discriminant over document statistics."""

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from rinkflow.llm import words as W
from rinkflow.llm.workers import release, ship

#: What a covariance gives to the pooled variances, and what every variance gets.
SHRINKAGE = 0.1
RIDGE = 1e-3
#: Bytes at which a text's statistics count half: those of a few words say little.
HALF_BYTES = 60
#: Bytes of text that are measured at a time: some dozen arrays hold eight bytes for each of them.
MEASURED_BYTES = 1 << 18
#: The statistics, in order; fractions are taken as log odds, lengths as logarithms.
STATISTICS = [
    "log_bytes", "log_word_length", "upper", "digits", "symbols", "exclamations", "stops",
    "other_marks", "non_ascii", "distinct_words", "repeated_words", "distinct_shingles",
    "short_words", "repeated_lines",
]

_KINDS = np.zeros(256, np.uint8)
for _kind, _bytes in enumerate(
    [range(65, 91), range(48, 58), b"#$%&*|<>_=^~\\@{}[]+", b"!?", b".,", b"-;:'\"()/", range(128, 256), range(97, 123)], 1
):
    _KINDS[list(_bytes)] = _kind


def _odds(part, whole):
    """Log odds of a fraction, pulled a little to the middle."""
    return np.log((part + 0.2) / (whole - part + 2.0))


def statistics(column):
    """A row of STATISTICS for each text; nulls count as empty."""
    out = []
    for a, b in W.chunks(column, MEASURED_BYTES):
        part = column.slice(a, b - a)
        data, offsets = W.column_bytes(part)
        kinds = _KINDS[data]
        of = lambda kind: np.diff(np.concatenate([[0], np.cumsum(kinds == kind)])[offsets])
        upper, digits, symbols, calls, stops, marks, high, lower = map(of, range(1, 9))
        hashes, at = W.word_hashes(part)
        n = np.diff(at)
        row = np.repeat(np.arange(len(n)), n)
        per_row = lambda flags: np.bincount(row, flags, minlength=len(n))
        same = np.zeros(len(hashes), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        distinct = np.diff(W.distinct_per_row(hashes, at)[1])
        shingles, to = W.shingle_hashes(hashes, at, 3)
        n_shingles = np.diff(to)
        distinct_shingles = np.diff(W.distinct_per_row(shingles, to)[1])
        solid = ~W.SPACE[data]
        size = np.diff(offsets)
        letters = np.diff(np.concatenate([[0], np.cumsum(solid)])[offsets])
        short = _short_words(data, offsets)
        lines = [t.split("\n") for t in part.fill_null("").to_pylist()]
        n_lines = np.array([len(x) for x in lines])
        own_lines = np.array([len(set(x)) for x in lines])
        out.append(
            np.column_stack(
                [
                    np.log1p(size),
                    np.log((letters + 5.0) / (n + 1.0)),
                    _odds(upper, upper + lower + high),
                    _odds(digits, letters),
                    _odds(symbols, letters),
                    _odds(calls, letters),
                    _odds(stops, letters),
                    _odds(marks, letters),
                    _odds(high, letters),
                    _odds(n - distinct, n) - 0.5 * np.log1p(n),
                    _odds(per_row(same), n),
                    _odds(n_shingles - distinct_shingles, n_shingles),
                    _odds(short, n),
                    _odds(n_lines - own_lines, n_lines),
                ]
            )
        )
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


def _short_words(data, offsets):
    """Words of up to three bytes in each text."""
    solid = np.concatenate([~W.SPACE[data], [False]])
    inside = np.ones(len(data) + 1, bool)
    inside[offsets[:-1]] = False  # a text begins
    start = solid & ~(np.concatenate([[False], solid[:-1]]) & inside)
    going = lambda k: np.concatenate([solid[k:] & inside[k:], np.zeros(k, bool)])[: len(solid)]
    long = start.copy()
    for k in (1, 2, 3):
        long &= going(k)
    return np.diff(np.concatenate([[0], np.cumsum(start & ~long)])[offsets])


def measure(docs, columns=("doc_id",), text_column="text"):
    """``columns`` of each document with its ``statistics`` (array of doubles)."""
    ship(docs.sparkSession)
    kept = docs.select(*columns, F.col(text_column).alias("_text_"))

    def run(batches):
        for batch in batches:
            rows = statistics(batch.column(batch.num_columns - 1))
            flat = pa.ListArray.from_arrays(
                np.arange(0, rows.size + 1, len(STATISTICS), dtype=np.int32), pa.array(rows.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], flat], names=[*batch.schema.names[:-1], "statistics"]
            )
        release()

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema[:-1])
    return kept.mapInArrow(run, f"{fields}statistics array<double>")


class Model:
    """Means, Cholesky factors and priors of the two classes; ``prior`` alone if one lacks rows."""

    def __init__(self, moments):
        """moments: {class: (n, sums, sums of products)}."""
        counts = [moments[k][0] if k in moments else 0 for k in (0, 1)]
        self.prior = np.log((counts[1] + 1) / (counts[0] + 1))
        self.classes = None
        if min(counts) < 2:
            return
        means, spreads = [], []
        for k in (0, 1):
            n, sums, products = moments[k]
            means.append(sums / n)
            spreads.append(products / n - np.outer(means[-1], means[-1]))
        pooled = np.diag((counts[0] * spreads[0] + counts[1] * spreads[1]).diagonal() / sum(counts))
        self.classes = []
        for mean, spread in zip(means, spreads):
            spread = (1 - SHRINKAGE) * spread + SHRINKAGE * pooled + RIDGE * np.eye(len(mean))
            factor = np.linalg.cholesky(spread)
            self.classes.append((mean, np.linalg.inv(factor), 2 * np.log(factor.diagonal()).sum()))

    def score(self, rows):
        """The probability of class 1 for each row of statistics.

        Prior log odds plus the difference of the classes' log densities, which
        counts in full for long texts and not at all for empty ones.
        """
        size = np.expm1(rows[:, STATISTICS.index("log_bytes")])
        weight = size / (size + HALF_BYTES)
        difference = np.full(len(rows), self.prior)
        for sign, (mean, inverse, log_det) in zip((-1, 1), self.classes or []):
            far = ((rows - mean) @ inverse.T) ** 2
            difference += weight * sign * -0.5 * (far.sum(axis=1) + log_det)
        return 1 / (1 + np.exp(-np.clip(difference, -50, 50)))


def fit(measured, labels, id_column="doc_id", label_column="quality"):
    """The model of all rows of ``measured`` whose id has a label of 0 or 1.

    Counts, sums and sums of products are added up by class on the map side, so
    the driver gets two rows. Other labels and nulls teach nothing; repeated
    rows count as often as they come. With fewer than two rows of a class the
    model knows only the shares of the classes.
    """
    d = range(len(STATISTICS))
    labels = labels.select(F.col(id_column).alias("_id_"), F.col(label_column).cast("int").alias("_label_"))
    labels = labels.where("_label_ in (0, 1)")
    rows = measured.select(F.col(id_column).alias("_id_"), "statistics").join(labels, "_id_")
    x = [F.col("statistics")[i] for i in d]
    sums = rows.groupBy("_label_").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(x[i]) for i in d]).alias("sums"),
        F.array(*[F.sum(x[i] * x[j]) for i in d for j in d if j <= i]).alias("products"),
    )
    moments = {}
    for label, n, total, products in sums.collect():
        square = np.zeros((len(d), len(d)))
        square[np.tril_indices(len(d))] = products
        square = np.tril(square) + np.tril(square, -1).T
        moments[label] = (n, np.array(total), square)
    return Model(moments)


def score(measured, model):
    """``measured`` without its statistics, with ``score`` (0 to 1) and ``predicted`` (0 or 1)."""
    spark = measured.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    kept = [c for c in measured.columns if c not in ("statistics", "score", "predicted")]

    def run(batches):
        for batch in batches:
            flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            found = held.value.score(flat.reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                names=[*batch.schema.names[:-1], "score", "predicted"],
            )

    fields = "".join(f"`{c}` {measured.schema[c].dataType.simpleString()}, " for c in kept)
    return measured.select(*kept, "statistics").mapInArrow(run, f"{fields}score double, predicted int")


def text_score(text, model):
    """The ``score`` of a text column as a column, so that only the texts visit Python and nothing but scores comes back."""
    ship(SparkSession.active())

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found = pa.array(model.score(statistics(texts)), pa.float64())
        release()
        return found

    return run(text)
