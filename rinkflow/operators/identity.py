"""Fuzzy resolution of (name, country) to a registry id.

A lookup asks the registry of a country for families that start with a text
and takes the first row, in registry order, whose given name is similar enough.  Names are
not paired with registry rows.  The registry is reduced to the first row for each country,
family prefix that is asked for and given name.  A similarity above s leaves fewer than
(1 - s) of the letters of two names unmatched, say at most u.  Given names of up to
WHOLE_NAME letters in the registry meet by what both are without those letters: similar
names of a and b letters share a subsequence of (a + b - u) / 2 letters, rounded up, which
few other names have.  Longer ones meet by pieces: of u + 1 pieces of one name at least one
stands whole in the other, at most u letters from its place.  Country, prefix, length and
subsequence or piece are the join key.

How the original remote lookup compared families is not known; here both sides
are compared in normalised form (lower case, a-z only).
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow import fixed_values as fixed
from rinkflow.functions.similarity import lengths_agree, sequence_ratio
from rinkflow.functions.text import (
    family_name, given_name, has_text, name_prefix, normalize_name, trim_or_empty, upper_country,
)
from rinkflow.session import materialize


#: Names of the registry up to this length meet by subsequences: an asked name drops at most four letters for them.
WHOLE_NAME = 22

_NO_KEYS = "cast(array() AS array<struct<size:int, part:int, piece:string>>)"


def first_candidates(rows: DataFrame, block, order, limit=fixed.CANDIDATES_PER_LOOKUP):
    """The first ``limit`` rows of each block; limited before the shuffle as well."""
    w = Window.partitionBy(*block).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit).drop("_rank")


def first_match(
    candidates: DataFrame, block, order, accepted, id_col="id", limit=fixed.CANDIDATES_PER_LOOKUP
):
    """Id of the first accepted row among the first ``limit`` of each block."""
    kept = first_candidates(candidates, block, order, limit).where(accepted)
    return kept.groupBy(*block).agg(F.min_by(id_col, F.struct(*order)).alias(id_col))



def _unmatched(letters, similarity):
    """SQL: the most letters that two names of so many letters in all may leave unmatched."""
    return f"int(greatest(0, ceil(({letters}) * {1 - similarity!r}D - 1e-9D) - 1))"


def _most_unmatched(size, similarity):
    """SQL: the same for a name of ``size`` letters and any other."""
    return f"int(greatest(0, ceil(({size}) * {2 * (1 - similarity) / similarity!r}D - 1e-9D) - 1))"


def _piece(size, part, similarity):
    """SQL: (start from 0, length) of a piece of a name of ``size`` letters."""
    pieces = f"({_most_unmatched(size, similarity)} + 1)"
    start = f"int({part} * {size} div {pieces})"
    return start, f"(int(({part} + 1) * {size} div {pieces}) - {start})"


def pieces_of(name, similarity=fixed.MIN_SIMILARITY):
    """SQL: array of (size, part, piece) of a long name that is looked up in."""
    size = f"length({name})"
    start, length = _piece(size, "j", similarity)
    pieces = f"""transform(sequence(0, {_most_unmatched(size, similarity)}),
      j -> struct({size} AS size, j AS part, substring({name}, {start} + 1, {length}) AS piece))"""
    return f"IF({size} > {WHOLE_NAME}, {pieces}, {_NO_KEYS})"


def pieces_sought(name, sizes, similarity=fixed.MIN_SIMILARITY):
    """SQL: array of (size, part, piece) that a similar long name of one of ``sizes`` would have, sought around their places."""
    if not sizes:
        return _NO_KEYS
    size = f"length({name})"
    most = _most_unmatched(size, similarity)
    left = _unmatched(f"{size} + b", similarity)
    start, length = _piece("b", "j", similarity)
    places = f"filter(sequence({start} - {left}, {start} + {left}), at -> at >= 0 AND at + {length} <= {size})"
    parts = f"""transform(sequence(0, {_most_unmatched("b", similarity)}),
      j -> transform({places}, at -> struct(b AS size, j AS part, substring({name}, at + 1, {length}) AS piece)))"""
    present = f"array({', '.join(map(str, sizes))})"
    near = f"abs({size} - b) <= {most} + 1 AND {left} >= abs({size} - b)"
    sizes = f"filter({present}, b -> {near})"
    return f"array_distinct(flatten(flatten(transform({sizes}, b -> {parts}))))"


def _shared(a, b, similarity=fixed.MIN_SIMILARITY):
    """The letters that similar names of a and b letters share at least, 0 if there are none such."""
    unmatched = max(0, math.ceil((a + b) * (1 - similarity) - 1e-9) - 1)
    shared = -(-(a + b - unmatched) // 2)
    return shared if shared <= min(a, b) else 0


def _sizes(names: DataFrame, name):
    """The lengths of names that there are: the only ones worth keys."""
    return sorted(r[0] for r in names.select(F.length(name)).distinct().collect() if r[0])


def _with_keys(df: DataFrame, name, wanted, more):
    """``df`` with a row for every key (size, part, piece) of a name: those of ``more``, an array,
    and its subsequences.  ``wanted`` maps a length of name to the (size, letters) of these."""
    most = max((size - left for size in wanted for _, left in wanted[size]), default=0)
    # A letter is dropped at the head of its run: elsewhere in the run the rest is the same.
    head = "i = 1 OR substring(s, i, 1) != substring(s, i - 1, 1)"
    rest = f"transform(filter(sequence(1, length(s)), i -> {head}), i -> concat(substring(s, 1, i - 1), substring(s, i + 1)))"
    rows = df.withColumn("_less0", F.array(name))
    for n in range(1, most + 1):
        deep = [str(size) for size in wanted if any(size - left >= n for _, left in wanted[size])]
        less = f"array_distinct(flatten(transform(_less{n - 1}, s -> {rest})))"
        rows = rows.withColumn(f"_less{n}", F.expr(f"IF(length({name}) IN ({', '.join(deep)}), {less}, array())"))
    keys = lambda at, size, left: f"transform(_less{at - left}, p -> struct({size} AS size, -1 AS part, p AS piece))"
    cases = [
        f"WHEN {at} THEN concat({', '.join(keys(at, size, left) for size, left in pairs)})" for at, pairs in wanted.items() if pairs
    ]
    whole = f"CASE length({name}) {' '.join(cases)} ELSE {_NO_KEYS} END" if cases else _NO_KEYS
    return rows.select(*df.columns, F.expr(f"inline(concat({whole}, {more}))"))


def prefix_index(registry: DataFrame, asked: DataFrame, candidates=None):
    """(country, family prefix, given name) -> its first registry row, for prefixes (country, prefix) that are ``asked``.

    With ``candidates`` only so many rows of each country and prefix, in
    registry order, are there to be found; their families are kept.
    """
    rows = registry.select(
        upper_country("country").alias("block_country"),
        F.coalesce(normalize_name("familyname"), F.lit("")).alias("family"),
        F.coalesce(normalize_name("givenname"), F.lit("")).alias("other"),
        F.col("id").cast("string").alias("id"),
        "pos",
    ).where(F.col("block_country").isNotNull())
    lengths = F.sequence(F.lit(0), F.length("family"))
    prefixes = F.transform(lengths, lambda n: F.substring("family", F.lit(1), n))
    blocks = rows.withColumn("block", F.explode(prefixes)).join(asked, ["block_country", "block"], "left_semi")
    key = ["block_country", "block", "other"]
    if candidates:
        blocks = first_candidates(blocks, ["block_country", "block"], ["pos", "id", "other", "family"], candidates)
        key.append("family")
    return blocks.where("other != ''").groupBy(*key).agg(F.min(F.struct("pos", "id")).alias("first"))


def _look_up(people: DataFrame, index: DataFrame, sizes, key, needed, out, must=None):
    """One pass: the id of the first registry row that fits, or NULL, as ``out``.

    ``index`` has a row for each key; of ``sizes`` the first maps the lengths of short names to the
    subsequences to ask for, the second lists the long ones.
    Stored rows take far more room in memory than in their files, so that joins are told to merge.

    ``key`` is the prefix that families are asked for; with ``must`` they have
    to start with that as well.
    """
    asked = people.where(needed & has_text("given")).select(
        F.col("country_key").alias("block_country"), F.col(key).alias("block"), "given", F.col(must or key).alias("must")
    )
    # Few bytes, but much work each: as many tasks as the session shuffles over, however few bytes there are.
    asked = asked.distinct().repartition(int(people.sparkSession.conf.get("spark.sql.shuffle.partitions")), *asked.columns)
    asked = _with_keys(asked, "given", sizes[0], pieces_sought("given", sizes[1]))
    met = asked.join(index.hint("merge"), ["block_country", "block", "size", "part", "piece"])
    if must:
        met = met.where(F.startswith("family", F.col("must")))
    near = f"levenshtein(given, other, {_unmatched('length(given) + length(other)', fixed.MIN_SIMILARITY)}) >= 0"
    ask = ["block_country", "block", "must", "given"]
    pairs = materialize(met.select(*ask, "other", "first").distinct().where(f"given = other OR {near}"))
    # The ratio is found once for each pair of names, wherever they meet.
    unequal = pairs.where(F.col("given") != F.col("other")).select("given", "other").distinct()
    ratio = sequence_ratio("other", "given")
    alike = unequal.where(lengths_agree("given", "other")).where(ratio > fixed.MIN_SIMILARITY)
    hits = pairs.where(F.col("given") == F.col("other")).unionByName(pairs.join(alike.hint("merge"), ["given", "other"]))
    found = hits.groupBy(*ask).agg(F.min("first")["id"].alias("_found"))
    found = found.withColumnsRenamed({c: f"_{c}" for c in ask})
    same = (
        (F.col("country_key") == F.col("_block_country")) & (F.col(key) == F.col("_block"))
        & (F.col(must or key) == F.col("_must")) & (people["given"] == F.col("_given"))
    )
    joined = people.join(found.hint("merge"), same & needed, "left")
    return joined.withColumn(out, F.when(has_text("_found"), F.col("_found"))).drop(*found.columns)


def resolve_entities(names: DataFrame, registry: DataFrame, name="Name", country="Country", candidates=None):
    """Distinct (name, country) with the registry id found, or NULL.

    Pass 1 looks up the whole family name; pass 2, for names still without an
    id and a family of at least four characters, its first four.  All registry
    rows of a family are looked at; with ``candidates`` (the original: ten) only
    the first so many of each lookup.
    """
    length = fixed.PARTIAL_FAMILY_LENGTH
    people = (
        names.select(trim_or_empty(name).alias(name), trim_or_empty(country).alias(country))
        .distinct()
        .select(
            "*",
            upper_country(country).alias("country_key"),
            normalize_name(given_name(name)).alias("given"),
            family_name(name).alias("family_text"),
        )
        .withColumn("family", normalize_name("family_text"))
        .withColumn("family_part", normalize_name(name_prefix("family_text")))
        .withColumn("family_start", name_prefix("family", length))
    )
    second_key = "family_part" if candidates else "family_start"
    keys = F.array("family", second_key)
    blocks = people.select(F.col("country_key").alias("block_country"), F.explode(keys).alias("block")).distinct()
    index = materialize(prefix_index(registry, blocks, candidates))  # read by both passes
    asked_sizes, sizes = _sizes(people, "given"), _sizes(index, "other")
    short = [b for b in sizes if b <= WHOLE_NAME]
    long = [b for b in sizes if b > WHOLE_NAME]
    sought = {a: [(b, _shared(a, b)) for b in short if _shared(a, b)] for a in asked_sizes}
    kept = {b: sorted({(b, _shared(a, b)) for a in asked_sizes if _shared(a, b)}) for b in short}
    index = _with_keys(index, "other", kept, pieces_of("other"))
    asked = has_text(name) & has_text(country)
    whole = _look_up(people, index, (sought, long), "family", asked, "_id1")
    second = asked & F.col("_id1").isNull() & (F.length("family_text") >= length)
    # Families that start with the whole name start with its first four letters too.
    must = "family_start" if candidates else None
    both = _look_up(whole, index, (sought, long), second_key, second, "_id2", must)
    return both.select(name, country, F.coalesce("_id1", "_id2").alias("id"))
