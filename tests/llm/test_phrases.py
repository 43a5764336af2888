"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rinkflow.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain_collocations(docs, longest=3, least=10, percent=50, top=2000):
    """{lang: [(rank, phrase, a, l, r, n, score, path)]} and the counts, by the definition."""
    out = {}
    for lang in {x or "und" if x is None else x for _, x in docs}:
        f = Counter()
        n = 0
        begins, ends = Counter(), Counter()
        for text, x in docs:
            if ("und" if x is None else x) != lang:
                continue
            for w in pieces(text):
                n += len(w)
                for m in range(1, longest + 1):
                    f.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
                if len(w) >= longest - 1:
                    begins[tuple(w[: longest - 1])] += 1
                    ends[tuple(w[1 - longest :])] += 1
        found = {g for g in f if len(g) > 1 and f[g] >= least}
        around = Counter()
        for g in found:
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    around[g[i : i + m]] = max(around[g[i : i + m]], f[g])
        edges = [g for g in f if len(g) == longest]
        into, out_of = {}, {}
        for g in edges:
            into.setdefault(g[1:], []).append(g)
            out_of.setdefault(g[:-1], []).append(g)
        unary = lambda v: len(into.get(v, [])) == len(out_of.get(v, [])) == 1 and not begins[v] and not ends[v]

        def path(g):
            if len(g) < longest:
                return " ".join(g)
            words = list(g)
            while unary(tuple(words[: longest - 1])):
                words.insert(0, into[tuple(words[: longest - 1])][0][0])
            while unary(tuple(words[1 - longest :])):
                words.append(out_of[tuple(words[1 - longest :])][0][-1])
            return " ".join(words)

        rows = []
        for g in found:
            if 100 * around[g] >= percent * f[g]:
                continue
            cuts = [(10**6 * f[g] ** 2 // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            rows.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]], path(g)))
        rows.sort()
        out[lang] = [
            (i, p.decode(), -a, left, right, n, -s, way) for i, (s, a, p, left, right, way) in enumerate(rows[:top], 1)
        ]
    return out


def ours(df):
    out = {}
    for r in df.orderBy("lang", "rank").collect():
        out.setdefault(r.lang, []).append(tuple(r)[1:])
    return out


def corpus(seed, n=250):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "ÉTÉ", "x" * 90 + "1", "x" * 90 + "2", "a\x00b", "漢字"]
    fixed = "all rights reserved by the owner of this fixed passage. new york city"
    docs = []
    for _ in range(n):
        words = rng.choices(vocabulary, [8, 2, 6, 5, 5, 4, 1, 1, 1, 1, 1], k=rng.randrange(0, 40))
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "!"]) for w in words)
        text += rng.choice(["", fixed, f"\x0b{fixed.upper()}", f"{fixed};{fixed}"])
        docs.append((text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return [*docs, (None, "en"), ("", None), ("... !?", "fr"), ("lone", "it"), *[("lone", "pt")] * 12]


@pytest.mark.parametrize("options", [{}, {"longest": 2}, {"longest": 4, "least": 5}, {"longest": 5, "least": 3, "top": 7}, {"percent": 101}])
def test_equals_brute_force(spark, options):
    docs = corpus(len(options))
    table = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "text string, lang string, n int, node string, gram string")
    expected = {k: v for k, v in plain_collocations(docs, **options).items() if v}
    assert ours(phrases.collocations(table.repartition(7), **options)) == expected
    assert any(len(r[-1].split()) > 3 for rows in expected.values() for r in rows) or options.get("longest") == 2


def test_ties_are_in_order_of_bytes_and_empty_tables_are_empty(spark):
    docs = [("b c. a b! é f; Z z, z z", "en")] * 10
    table = spark.createDataFrame(docs, "text string, lang string")
    expected = plain_collocations(docs)
    assert ours(phrases.collocations(table)) == expected
    assert phrases.collocations(table.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    # One phrase counted 9e9 times would need more text than a test has: the arithmetic alone.
    from pyspark.sql import functions as F

    a, left, right = 9_000_000_019, 9_000_000_033, 9_100_000_001
    row = spark.range(1).select(*[F.lit(v).cast("decimal(19,0)").alias(k) for k, v in zip("alr", (a, left, right))])
    product = F.lit(1_000_000).cast("decimal(7,0)") * (F.col("a") * F.col("a"))
    found = row.select(product.alias("s"), (F.col("l") * F.col("r")).alias("p")).select(F.expr("s div p")).first()[0]
    assert found == 10**6 * a * a // (left * right)


def test_a_long_text_is_cut_at_breaks_only():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("ab  .,\n"), 5000))
    count = Counter()
    for size in (60, 10**6):
        mine = Counter()
        texts = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["l", "t"])
        for batch in phrases._grams([texts], 3, 4, size):
            for line in "\n".join(batch.column("lines").to_pylist()).split("\n"):
                gram, _, times = line.partition("\t")
                mine[gram] += int(times or 1)
        assert not count or mine == count
        count = mine
    assert sum(count.values()) == sum(map(len, pieces(text)))
