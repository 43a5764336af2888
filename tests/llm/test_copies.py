"""Near copies, licenses, decontamination and components against brute force."""

import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from rinkflow.llm import components, decontamination, licenses, near_copies, queries
from rinkflow.llm import words as W

FOLDER = "/root/testdata/sf0.001"


def shingles(text, size):
    words = (text or "").encode().lower().split()
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def groups(rows, size, percent):
    """{row: (set size, smallest id reachable)} by comparing all pairs."""
    sets = [frozenset(shingles(text, size)) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {rows[i][0]: (len(sets[i]), least[find(i)]) for i in range(len(rows))}


def test_words_and_chunks():
    texts = pa.array(["The end", None, "", " \t", "x" * 9000, "END the\nthe"])
    hashes, offsets = W.word_hashes(texts)
    assert offsets.tolist() == [0, 2, 2, 2, 2, 3, 6]
    assert hashes[1] == hashes[3] and hashes[0] == hashes[4] == hashes[5] and len(set(hashes.tolist())) == 3
    assert [*W.chunks(texts, 9000)] == [(0, 4), (4, 5), (5, 6)]
    assert [*W.chunks(pa.array(["ab"] * 10, pa.string()), 6)] == [(0, 3), (3, 6), (6, 9), (9, 10)]
    assert [*W.chunks(pa.array([], pa.string()))] == []


def test_op4_over_the_table(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = queries.op4_near_copies(spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows, 3, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def crowd(seed=5):
    """A crowded region: many near copies of one text, and other texts that share most of a passage."""
    pick = random.Random(seed)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(pick.randint(0, 3)):
            words[pick.randrange(60)] = f"n{pick.randrange(40)}"
        rows.append((1000 + i, " ".join(words)))
    for i in range(80):
        own = [f"o{i // 2}x{k}" for k in range(pick.randint(10, 14))]
        rows.append((5000 + i, " ".join(base[:50] + own)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("window", [1, 12])
def test_crowded_regions_are_searched_whole(spark, monkeypatch, window):
    """With the narrowest window what the forest leaves out must come from the exact search."""
    monkeypatch.setattr(near_copies, "WINDOW", window)
    rows = crowd()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_copies.near_copies(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows, 5, 80)


def test_candidates_in_a_crowded_region_are_not_made_as_rows(spark, monkeypatch):
    """Texts that share most minima and are no near copies: signatures meet rows, not candidates."""
    pick = random.Random(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        words = list(base)
        for k in range(6):
            words[pick.randrange(60)] = f"n{i}x{k}"
        rows.append((i, " ".join(words)))
    made, plain = [], near_copies._both

    def counted(pairs, table, value):
        made.append(pairs.count())
        return plain(pairs, table, value)

    monkeypatch.setattr(near_copies, "_both", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_copies.near_copies(docs, 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == groups(rows, 2, 80)
    trees = near_copies.trees_for(80)
    assert sum(made) <= len(rows) * 2 * trees


def test_near_copies_edge_rows(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n"), (9, "One two"), (4, "one TWO"), (5, long), (6, long + " x"), (None, long), (6, long + " x"), (7, "one two three")]
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, component_id int, kept boolean")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_copies.near_copies(docs, 3, 85).collect())
    assert got == [
        (0, 29998, None, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 29998, 5, True),
        (6, 29999, 5, False), (6, 29999, 5, False), (7, 1, 7, True), (9, 1, 4, False),
    ] or got[0] == (0, 29998, None, True)
    assert near_copies.near_copies(docs.limit(0)).count() == 0


def test_rows_that_reuse_an_id_go_by_their_own_texts(spark):
    """Ids 5 and 7 share 58 of 59 shingles through the second text of 7; its first text is alone."""
    words = [f"w{i}" for i in range(63)]
    rows = [(5, " ".join(words)), (7, "something else altogether of seven words"), (7, " ".join([*words[:-1], "x"])), (9, "w1 " * 9)]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(3)
    found = near_copies.near_copies(docs).join(docs.distinct().selectExpr("xxhash64(text) AS text_key", "text"), "text_key")
    got = {(r.doc_id, r.text): (r.component_id, r.kept) for r in found.collect()}
    assert found.count() == 8
    assert got == {rows[0]: (5, True), rows[1]: (7, True), rows[2]: (5, False), rows[3]: (9, True)}


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (None, 3), (7, 7), (101, 100)]
    out = components.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert Counter(r.component_id for r in out) == {1: 40, 100: 2}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_license_edge_rows(spark):
    templates = [("MIT", "Released under the MIT License."), (None, "x y z"), ("none", "?!"), ("short", "all rights"), ("MIT", "The MIT licence text here")]
    notice = " ".join(f"n{i}" for i in range(200))
    templates.append(("long", notice))
    kept = " ".join(w for i, w in enumerate(notice.split()) if i != 50)
    docs = [
        (1, "foo Released, under the mit LICENSE bar", 1), (2, None, 1), (3, "", 1), (4, "released under the MIT", 1),
        (5, "x " * 40000 + kept + " y", 1), (None, "All rights!", 1), (1, "foo Released, under the mit LICENSE bar", 1),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string, containment int")
    templates = spark.createDataFrame(templates, "license_id string, text string")
    out = sorted((r.doc_id or 0, r.license_id, round(r.containment, 3)) for r in licenses.scan_licenses(docs, templates).collect())
    assert out == [(0, "short", 1.0), (1, "MIT", 1.0), (1, "MIT", 1.0), (5, "long", round(191 / 196, 3))]
    assert licenses.scan_licenses(docs, templates.limit(0)).count() == 0
    assert licenses.scan_licenses(docs.limit(0), templates).count() == 0


def test_license_windows_miss_nothing_at_the_threshold(spark):
    """Templates of many lengths with a fifth of their shingles destroyed, anywhere in a text."""
    pick = random.Random(2)
    names, docs = [], []
    for n in range(6, 120, 3):
        words = [f"l{n}w{i}" for i in range(n)]
        names.append((f"t{n}", " ".join(words)))
        cut = list(words)
        if n > 30:
            cut[pick.randrange(n)] = "gone"
        docs.append((n, " ".join(["pad"] * pick.randrange(300) + cut + ["end"] * pick.randrange(50))))
    found = licenses.scan_licenses(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(names, "license_id string, text string")
    ).collect()
    assert sorted((r.doc_id, r.license_id) for r in found) == [(n, f"t{n}") for n in range(6, 120, 3)]


def overlap(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_decontamination_against_all_windows(spark):
    """Planted passages, whole, edited and cut; every window of every text is compared."""
    pick = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    make = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    items = [make(pick.randint(15, 50)) for _ in range(20)] + [make(3)]
    docs = []
    for k in range(60):
        item = list(items[k % len(items)])
        for _ in range(k % 4):
            item[pick.randrange(len(item))] = "edit"
        if k % 7 == 0:
            del item[len(item) // 2]
        if k % 5 == 0:
            item = item[: len(item) // 2]
        docs.append(make(pick.randint(0, 60)) + item + make(pick.randint(0, 60)))
    docs.append(items[-1])
    wanted = set()
    for d, words in enumerate(docs):
        for i, item in enumerate(items):
            own = shingles(" ".join(item), 5)
            for at in range(max(1, len(words) - len(item) + 1)):
                if len(words) < 5 or len(item) >= 5:
                    window = shingles(" ".join(words[at : at + len(item)]), 5)
                    if overlap(window, own) >= 0.8:
                        wanted.add((d, i))
    table = spark.createDataFrame([(d, " ".join(w), 1) for d, w in enumerate(docs)], "doc_id long, text string, word int")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(table, bench).collect()}
    assert len(wanted) > 10 and got == wanted


def test_decontamination_between_diagonals(spark):
    """Words inserted in the middle and halves swapped: the best windows lie between two diagonals."""
    pick = random.Random(6)
    items = [[f"i{k}w{i}" for i in range(100)] for k in range(8)]
    docs = []
    for item, more in zip(items, [6, 2, 4, 8, 12, 1]):
        edited = ["x", "y", "z", *item[3:50], *[f"new{i}" for i in range(more)], *item[50:97], "x", "y", "z"]
        docs.append([f"a{i}" for i in range(40)] + edited + [f"b{i}" for i in range(40)])
    docs += [["c"] * 50 + item[a:] + item[:a] + ["d"] * 50 for item, a in zip(items[6:], (50, pick.randrange(20, 80)))]
    wanted = {}
    for d, words in enumerate(docs):
        own = shingles(" ".join(items[d]), 5)
        best = max(overlap(shingles(" ".join(words[at : at + 100]), 5), own) for at in range(len(words) - 99))
        if best >= 0.8:
            wanted[d, d] = best
    table = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.contaminated(table, bench).collect()}
    assert {(0, 0), (6, 6), (7, 7)} <= wanted.keys() and got == pytest.approx(wanted)


def test_decontamination_edge_rows(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(1, None), (2, ""), (None, "a " + passage), (3, "A " + passage.upper()), (3, "A " + passage.upper()), (4, "z " * 30000 + passage)]
    bench = [(7, passage), (None, passage), (8, None), (9, " "), (7, passage)]
    docs = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(bench, "item_id long, text string")
    out = decontamination.contaminated(docs, bench)
    got = sorted((r.doc_id or 0, r.item_id, r.similarity, r.word) for r in out.collect())
    assert got == [(0, 7, 1.0, 1), (3, 7, 1.0, 1), (4, 7, 1.0, 30000)]
    assert "Python" not in out._jdf.queryExecution().toString()
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0


def test_blocks_find_all_fingerprints_within_the_radius(spark):
    pick = random.Random(8)
    mask = (1 << 64) - 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    one = pick.getrandbits(128)
    rows = []
    for k in range(40):
        other = one
        for bit in pick.sample(range(128), decontamination.RADIUS):
            other ^= 1 << bit
        rows.append((k, signed(other & mask), signed(other >> 64)))
    probes = decontamination._probes(spark.createDataFrame(rows, "k int, f0 long, f1 long"), decontamination.WINDOW_FLIPS)
    sought = decontamination._probes(spark.createDataFrame([(signed(one & mask), signed(one >> 64))], "f0 long, f1 long"), decontamination.ITEM_FLIPS)
    assert probes.join(sought, ["block", "value"]).select("k").distinct().count() == 40


def test_sets_take_bounded_memory_beside_the_text():
    """A worker holds the words and shingles of a part of its texts at a time."""
    text = pa.array([" ".join(f"w{i * 7 + j}" for j in range(300)) for i in range(4000)])
    assert text.nbytes > 5 << 20
    tracemalloc.start()
    try:
        parts = [(a, b, len(offsets)) for a, b, _, offsets in near_copies._sets_by_chunk(text, 5)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [b for _, b, _ in parts[:-1]] == [a for a, _, _ in parts[1:]]
    assert parts[-1][1] == 4000
    assert peak < 150 << 20
