"""Benchmark decontamination by SimHash of item-sized windows, in DataFrame functions only.

A window has as many words as some benchmark item. Its fingerprint is the
BITS-bit SimHash of its word shingles, each with its number of occurrences as
weight. Fingerprints are cut into blocks; two of them within RADIUS bits differ
by at most RADIUS // blocks bits in some block, so probing each block with all
values that near finds every pair (the window's side flips one bit, the item's
side the others). Candidates are confirmed by the exact weighted similarity of
their shingles.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow.session import materialize

SHINGLE = 5
BITS, BLOCK_BITS, RADIUS = 128, 16, 31
BLOCKS = BITS // BLOCK_BITS
WINDOW_FLIPS = 1
ITEM_FLIPS = RADIUS // BLOCKS - WINDOW_FLIPS
#: Rows of a side that is broadcast; beyond it both sides are shuffled.
FEW = 2_000_000

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = "[\\x20\\x09-\\x0D]+"


def _few(df):
    return F.broadcast(df) if df.count() <= FEW else df


def word_array(text):
    """Hashes of the words: runs of other than ASCII white space, A-Z lower-cased; null counts as empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), *_LETTERS)
    return F.transform(F.filter(F.split(lowered, _WHITE), lambda w: w != ""), lambda w: F.xxhash64(w))


def shingle_array(words):
    """Hashes of the shingles of SHINGLE words; of all words where there are fewer, none without words."""
    n = F.size(words)
    many = F.transform(
        F.sequence(F.lit(0), n - SHINGLE),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]),
    )
    short = F.array(F.xxhash64(F.lit("short"), words))
    return F.when(n >= SHINGLE, many).when(n > 0, short).otherwise(F.array().cast("array<long>"))


def _shingled(rows, keys):
    """``keys``, n_words and the shingles of ``text``.

    The words are bound as a lambda's variable: a column would be computed anew for each use.
    """
    bound = F.transform(
        F.array(word_array(F.col("text"))),
        lambda w: F.struct(F.size(w).alias("n_words"), shingle_array(w).alias("shingles")),
    )
    return rows.select(*keys, F.inline(bound))


def _fingerprints(rows, keys):
    """``keys``, n and the fingerprint (f0, f1) of rows of (keys, shingle), one per occurrence.

    Bits are counted four to a long, in lanes of 16 bits.
    """
    hashes = [F.col("shingle"), F.xxhash64("shingle")]
    sums = []
    for f, h in enumerate(hashes):
        for g in range(16):
            four = F.shiftrightunsigned(h, 4 * g)
            lanes = [F.shiftleft(four.bitwiseAND(F.lit(1 << k)), 15 * k) for k in range(4)]
            lane = lanes[0].bitwiseOR(lanes[1]).bitwiseOR(lanes[2]).bitwiseOR(lanes[3])
            sums.append(F.sum(lane).alias(f"s{f}_{g}"))
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums)

    def bits(f):
        out = F.lit(0).cast("long")
        for g in range(16):
            for k in range(4):
                count = F.shiftrightunsigned(F.col(f"s{f}_{g}"), 16 * k).bitwiseAND(F.lit(0xFFFF))
                bit = F.when(2 * count > F.col("n"), F.shiftleft(F.lit(1).cast("long"), 4 * g + k)).otherwise(F.lit(0).cast("long"))
                out = out.bitwiseOR(bit)
        return out

    return counted.select(*keys, "n", bits(0).alias("f0"), bits(1).alias("f1"))


def _flips(most):
    """All masks of a block with at most so many bits."""
    return [m for m in range(1 << BLOCK_BITS) if m.bit_count() <= most]


def _probes(fingerprints, flips):
    """``fingerprints`` once for every block and every value within so many bits of it."""
    per_long = 64 // BLOCK_BITS
    blocks = [
        F.shiftrightunsigned(F.col(f"f{b // per_long}"), BLOCK_BITS * (b % per_long)).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
        for b in range(BLOCKS)
    ]
    masks = F.array(*[F.lit(m) for m in _flips(flips)])
    rows = fingerprints.select("*", F.posexplode(F.array(*blocks)).alias("block", "value"))
    rows = rows.withColumn("mask", F.explode(masks))
    return rows.withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")


def _windows(spots, seeds, percent):
    """doc_id, text_key, word, size of all windows that can reach ``percent``.

    With n shingles an item needs 2 n percent / (100 + percent) of them in a
    window. One that starts outside the diagonals of its shared shingles gains
    by moving towards them. One between two neighbouring diagonals that lie g
    apart holds 2 n - g at most, so wider gaps need no windows. Nor do windows
    with fewer places that share a shingle with items of their size.
    """
    key = ["doc_id", "text_key", "size"]
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("place"), F.col("n_words") - F.col("size")))
    marks = F.array(
        F.struct(F.lit(True).alias("is_hit"), F.col("at").alias("x")),
        F.struct(F.lit(False).alias("is_hit"), start.alias("x")),
    )
    marks = spots.join(_few(seeds), "shingle").select(*key, "n_words", F.inline(marks))
    marks = materialize(marks.distinct())

    # Whole windows on the diagonals of shared shingles, moved inside the text, and between them.
    n = F.greatest(F.lit(1), F.col("size") - (SHINGLE - 1))
    following = F.lead("x").over(Window.partitionBy(*key).orderBy("x"))
    starts = marks.where("not is_hit").withColumn("gap", following - F.col("x")).withColumn("n", n)
    near = F.col("gap") * (100 + percent) <= 200 * F.col("n")
    last = F.col("x") + F.when(near, F.col("gap") - 1).otherwise(F.lit(0))
    starts = starts.select(*key, "n_words", "n", F.explode(F.sequence("x", last)).alias("word"))

    # Places that share a shingle inside each window: those before its end less those before it.
    no = F.lit(None).cast("int")
    before = starts.select(*key, "n_words", "n", "word", F.inline(F.array(
        F.struct(F.col("word").alias("x"), F.lit(-1).alias("sign")),
        F.struct((F.col("word") + F.col("n")).alias("x"), F.lit(1).alias("sign")),
    )))
    places = marks.where("is_hit").select(*key, "n_words", no.alias("n"), no.alias("word"), "x", F.lit(0).alias("sign"))
    so_far = Window.partitionBy(*key).orderBy("x").rangeBetween(Window.unboundedPreceding, -1)
    counted = before.unionByName(places).withColumn("so_far", F.count(F.when(F.col("sign") == 0, 1)).over(so_far))
    counted = counted.where("sign <> 0").groupBy(*key, "n_words", "n", "word")
    counted = counted.agg(F.sum(F.col("sign") * F.col("so_far")).alias("hits"))
    own = F.greatest(F.lit(1), F.least(F.col("size"), F.col("n_words")) - (SHINGLE - 1))
    enough = F.col("hits") * (100 + percent) >= percent * (own + F.col("n"))
    return counted.where(enough).select("doc_id", "text_key", "word", "size")


def contaminated(docs, items, percent=80, id_column="doc_id", text_column="text", item_id="item_id", item_text="text"):
    """doc_id, text_key, item_id, similarity, word: benchmark items that documents hold.

    A document holds an item if a window of as many words as the item (of all
    words where the document has fewer) has a weighted Jaccard similarity of at least ``percent`` in 100 with it: the sum of the
    smaller over the sum of the larger numbers of occurrences of every shingle
    of SHINGLE words. The row gives the best window's similarity and first word
    (the first of equal ones); ``text_key`` is the xxhash64 of the text.

    Only windows on the diagonals of shared shingles and between neighbouring
    ones are fingerprinted, and of those the ones with enough shared places
    (see ``_windows``): others are not better than these. Where a window
    outside the diagonals is as good, the row gives the one inside.

    Defined results: null, empty and blank texts and items hold nothing; items
    with a null id are left out; items with the same id count as one, the best
    match is given; documents with a null id come out with it; repeated rows
    come out once. A text of fewer than SHINGLE words is one shingle. Other
    columns are ignored; empty tables give no rows. Whole texts count. Items
    may have up to 65,535 words. A window at the threshold is within RADIUS but
    for a chance of two in a thousand; nearer ones are found all the surer.
    """
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    named = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("item_id is not null")
    # The texts of an item tell apart by their number of words and shingles.
    listed = _shingled(named, ["item_id"]).where("n_words > 0").distinct()
    listed = materialize(listed.withColumn("variant", F.xxhash64("shingles")))
    item_rows = listed.select("item_id", "variant", "n_words", F.posexplode("shingles").alias("place", "shingle"))
    seeds = item_rows.select("shingle", "place", F.col("n_words").alias("size")).distinct()

    own = _shingled(texts, ["doc_id", "text_key"])
    spots = own.select("doc_id", "text_key", "n_words", F.posexplode("shingles").alias("at", "shingle"))
    windows = materialize(_windows(spots, seeds, percent))
    found = materialize(windows.select("doc_id", "text_key").distinct())
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["text_key"].eqNullSafe(b["text_key"])
    held = _few(found)
    hit = materialize(texts.join(held, same(texts, held), "left_semi").dropDuplicates(["doc_id", "text_key"]))
    hit = _shingled(hit, ["doc_id", "text_key"])
    window_key = ["doc_id", "text_key", "word", "size"]
    inside = hit.join(windows, same(hit, windows)).select(
        hit["doc_id"], hit["text_key"], "word", "size",
        F.explode(F.slice("shingles", F.col("word") + 1, F.greatest(F.lit(1), F.col("size") - (SHINGLE - 1)))).alias("shingle"),
    )
    inside = materialize(inside.withColumn("window", F.xxhash64(*window_key)))

    prints = materialize(_fingerprints(inside, ["window"]))
    item_prints = _fingerprints(item_rows, ["item_id", "variant"]).withColumnRenamed("n", "item_n")
    probes = _probes(prints.select("f0", "f1").distinct(), WINDOW_FLIPS)
    sought = _probes(item_prints, ITEM_FLIPS).withColumnsRenamed({"f0": "g0", "f1": "g1"})
    near = F.bit_count(F.col("f0").bitwiseXOR(F.col("g0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("g1"))) <= RADIUS
    pairs = probes.join(sought, ["block", "value"]).where(near)
    pairs = pairs.select("f0", "f1", "item_id", "variant", "item_n").distinct()
    candidates = materialize(prints.join(pairs, ["f0", "f1"]).select("window", "n", "item_id", "variant", "item_n"))

    weights = inside.groupBy("window", "shingle").agg(F.count("*").alias("weight"))
    item_weights = item_rows.groupBy("item_id", "variant", "shingle").agg(F.count("*").alias("item_weight"))
    shared = candidates.join(weights, "window").join(item_weights, ["item_id", "variant", "shingle"])
    shared = shared.groupBy("window", "item_id", "variant").agg(
        F.sum(F.least("weight", "item_weight")).alias("both"),
        (F.first("n") + F.first("item_n")).alias("sizes"),
    )
    fit = shared.where(100 * F.col("both") >= percent * (F.col("sizes") - F.col("both"))).select(
        "window", "item_id", (F.col("both") / (F.col("sizes") - F.col("both"))).alias("similarity")
    )
    places = inside.select("window", "doc_id", "text_key", "word").distinct()
    best = F.max(F.struct("similarity", (-F.col("word")).alias("back"))).alias("best")
    return (
        fit.join(places, "window")
        .groupBy("doc_id", "text_key", "item_id")
        .agg(best)
        .select("doc_id", "text_key", "item_id", "best.similarity", (-F.col("best.back")).cast("long").alias("word"))
    )
