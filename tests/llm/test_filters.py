"""Span machine, filter audit and line dedup against plain Python."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from rinkflow.llm import filter_audit, line_dedup, spans

TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c",
    "Ünï CÖDE ÀB 漢字 \U0001f600",
    "a b a b aa a",
    "x" * 70 + "1 " + "x" * 70 + "2 " + "x" * 70 + "1",
    "12345678 123456789 12345678 1234567 123456789",
    "# one & two",
    " nbsp is no ASCII space",
    "word " * 300,
    " ".join(f"w{i}" for i in range(250)),
    "".join(random.Random(5).choice("ab \n") for _ in range(5000)),
    "z" * 300_000 + " " + "z" * 300_000,
]


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words),
        len(set(words)),
        len(re.findall("[A-Z]", text)),
        len(text),
        len(re.findall(r"[#$%&*|]", text)),
    ]


def test_counts_equal_those_of_regular_expressions():
    assert filter_audit.counts(pa.array(TEXTS)).T.tolist() == [plain_counts(t) for t in TEXTS]
    assert filter_audit.counts(pa.array([], pa.string())).shape == (5, 0)


def test_spans_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(spans.Table, "_hashes", lambda self: np.full(len(self.starts), 3, np.uint64))
    assert filter_audit.counts(pa.array(TEXTS[:9])).T.tolist() == [plain_counts(t) for t in TEXTS[:9]]


def plain_audit(docs, labels):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    failing = []
    for i, text, lang in docs:
        n, distinct, capitals, points, symbols = plain_counts(text)
        flags = [n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * points, symbols > 0]
        flags.append(i is not None and i > first[text or ""])
        quality = any(q == 1 for d, q, _ in labels if d == i and d is not None)
        toxic = any(t == 1 for d, _, t in labels if d == i and d is not None)
        failing.append((lang or "", {f for f, bad in zip("ABCDE", flags) if bad}, quality, toxic))
    out = {}
    for part in {p for p, *_ in failing}:
        mine = [x for x in failing if x[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                everyone = [x for x in mine if f in x[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    len(everyone) - len(gone),
                    sum(x[1] == {f} for x in everyone),
                    sum(x[2] for x in gone),
                    sum(x[3] for x in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def test_audit_equals_brute_force_with_ties_nulls_and_repeats(spark):
    rng = random.Random(3)
    pool = [*TEXTS, *[" ".join(rng.choice(["Alpha", "beta", "g#", "D"]) for _ in range(rng.choice([5, 99, 100, 101]))) for _ in range(30)]]
    docs = [(i if i % 17 else None, rng.choice(pool), rng.choice(["en", "", None, "xx"])) for i in range(150)]
    docs += docs[:5]  # repeated rows
    docs += [(docs[7][0], "same id, other text", "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 2)] + [(4, 1, 0), (None, 1, 1)]
    columns = "doc_id long, text string, lang string, part string, fails string, id string"
    table = spark.createDataFrame([(*d, "p", "f", "i") for d in docs], columns)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(table, known).collect()
    assert len(found) == 3 * 600
    assert {tuple(r)[:3]: list(tuple(r)[3:]) for r in found} == plain_audit(docs, labels)
    assert filter_audit.audit(table.limit(0), known).count() == 0
    assert filter_audit.audit(table, known.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def plain_dedup(docs, least_points=40, least_documents=5):
    strip = "\x20\t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(lower)
    holders = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= least_points:
                holders.setdefault(key(line), set()).add(i)
    common = {k: max(v) for k, v in holders.items() if len(v) >= least_documents}
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or common.get(key(x), i) == i]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((i, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=str)


LINES = [
    "",
    "short",
    "A line of exactly forty code points, ok!",
    "a LINE of exactly forty code points, OK!  \r",
    "\t a line of exactly thirty-nine points!",
    "ü" * 40,
    "Ü" * 40,
    " " + "b" * 39,
    *[f"line number {i} that many documents hold in common" for i in range(6)],
]


def digests(spark, docs, **columns):
    from pyspark.sql import functions as F

    kept = line_dedup.apply_maps(docs, line_dedup.keep_maps(docs, **columns))
    rows = kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("d")).collect()
    return sorted(map(tuple, rows), key=str)


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(8)
    docs = [(i, "\n".join(rng.choice(LINES) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    docs += [(i, LINES[8]) for i in range(100, 400)]  # one line in most documents
    docs += [(None, LINES[8]), (None, None), (500, None), (501, ""), (3, "another text\n" + LINES[9]), docs[0], docs[0]]
    docs += [(600, "\n".join([LINES[10]] * 500)), (601, "\n" * 10)]
    rng.shuffle(docs)
    table = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, id string, keep int, n_lines int")
    assert digests(spark, table) == plain_dedup(docs)
    assert digests(spark, table.limit(0)) == []


@pytest.mark.parametrize("seed", range(30))
def test_runs_are_the_same_however_rows_are_cut(seed):
    rng = random.Random(seed)
    rows = sorted(
        {(rng.randrange(6), 0, -rng.randrange(9), rng.randrange(2), rng.randrange(3)) for _ in range(rng.choice([5, 40, 200]))}
    )
    # Cut between (hash, id) pairs into partitions, and anywhere into batches.
    pairs = sorted({r[:3] for r in rows})
    bounds = sorted(rng.sample(pairs, min(len(pairs), rng.randrange(5))))
    partitions = [[] for _ in range(len(bounds) + 1)]
    for r in rows:
        partitions[sum(r[:3] >= b for b in bounds)].append(r)
    drops, edges, docs, largest = set(), [], {}, {}
    for part in partitions:
        batches, at = [], 0
        while at < len(part):
            to = at + rng.randrange(1, 12)
            columns = np.array(part[at:to], np.int64).T
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (columns[0], columns[1], -columns[2], columns[3], columns[4])],
                names=["h1", "h2", "id", "text_key", "place"],
            ))
            at = to
        for batch in line_dedup._first_occurrences(iter(batches), 3):
            for r in batch.to_pylist():
                h, i, mark = r["h1"], r["id"], (r["h1"], r["id"], r["text_key"], r["place"])
                if r["kind"] == line_dedup.DROP:
                    assert mark not in drops
                    drops.add(mark)
                elif r["kind"] == line_dedup.EDGE:
                    edges.append(mark)
                else:
                    docs[h] = docs.get(h, 0) + r["docs"]
                    largest[h] = max(i, largest.get(h, i))
    drops |= {m for m in edges if docs[m[0]] >= 3 and m[1] < largest[m[0]]}
    wanted = set()
    for h in range(6):
        ids = {-r[2] for r in rows if r[0] == h}
        if len(ids) >= 3:
            wanted |= {(h, -r[2], r[3], r[4]) for r in rows if r[0] == h and -r[2] < max(ids)}
    assert drops == wanted


def test_bitmaps_come_back():
    for n, dropped in [(1, []), (1, [0]), (9, [8, 0]), (10_000, range(0, 10_000, 3))]:
        keep = line_dedup.unpack(line_dedup.pack(n, np.array(list(dropped), int)), n)
        assert np.flatnonzero(~keep).tolist() == sorted(dropped)
