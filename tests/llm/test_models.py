"""Katz model against a plain restatement; classifiers by held-out accuracy and edge rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rinkflow.llm import katz, languages, quality, queries

FOLDER = "/root/testdata/sf0.001"


def katz_by_dictionaries(rows):
    """{id: (n_tokens, n_known, N, base, score)} of (id, text, held out), and the model's conditional."""
    tokens = [((text or "").encode().lower().split() + ["end"], held) for _, text, held in rows]
    single, pair, context = Counter(), Counter(), Counter()
    for words, held in tokens:
        if not held:
            single.update(words)
            for v, w in zip(["start", *words], words):
                pair[v, w] += 1
                context[v] += 1
    n_single, n_pair = Counter(single.values()), Counter(pair.values())
    d1 = katz.discounts([n_single[r] if r else 0 for r in range(katz.K + 2)])
    d2 = katz.discounts([n_pair[r] if r else 0 for r in range(katz.K + 2)])
    cut = lambda d, c: d[c] if c <= katz.K else 1.0
    total = sum(single.values())
    p = {w: cut(d1, c) * c / total for w, c in single.items()}
    unknown = 1 - math.fsum(p.values())
    after = defaultdict(dict)
    for (v, w), c in pair.items():
        after[v][w] = c
    size = {v: context[v] + all(c > katz.K for c in f.values()) for v, f in after.items()}
    seen = {v: {w: cut(d2, c) * c / size[v] for w, c in f.items()} for v, f in after.items()}
    back = {v: (1 - math.fsum(f.values())) / (1 - math.fsum(p[w] for w in f)) for v, f in seen.items()}

    def conditional(w, v):
        return seen[v][w] if v in seen and w in seen[v] else back.get(v, 1.0) * p.get(w, unknown)

    out = {}
    for (i, _, _), (words, _) in zip(rows, tokens):
        base = sum(math.log10((single[w] + 0.5) / (total + 0.5 * (len(single) + 1))) for w in words)
        score = sum(math.log10(conditional(w, v)) for v, w in zip(["start", *words], words))
        out[i] = (len(words), sum(w in single for w in words), total, base, score)
    return out, conditional, [*single], [*after]


def test_op3_over_the_table(spark, documents, monkeypatch):
    rows = [(r[0], r[1], zlib.crc32(str(r[0]).encode()) % 5 == 1) for r in documents.select("doc_id", "text").collect()]
    wanted, conditional, words, contexts = katz_by_dictionaries(rows)
    # The model is a distribution after every kind of context.
    for v in ["start", b"the", contexts[-1], "never seen"]:
        assert math.fsum(conditional(w, v) for w in [*words, "unknown"]) == pytest.approx(1, abs=1e-9)
    got = {r[0]: tuple(r)[1:] for r in queries.op3_katz(spark, FOLDER).collect()}
    assert len(got) == len(rows)
    for i, _, held in rows:
        assert got[i][0] == held and got[i][1:4] == wanted[i][:3]
        assert got[i][4:] == pytest.approx(wanted[i][3:], abs=1e-6)


def test_katz_does_not_depend_on_blocks_or_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(katz, "SPREAD", 3)
    rows = [(1, "a b a b c", False, 0.5), (2, None, False, 0.5), (None, "", True, 0.5), (3, "a x " * 500, False, 0.5), (3, "a x " * 500, False, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean, score double").repartition(3)
    got = sorted((r.doc_id or 0, *tuple(r)[2:]) for r in katz.score_documents(docs).collect())
    wanted, *_ = katz_by_dictionaries([(k, t, h) for k, (_, t, h, _) in enumerate(rows)])
    plain = sorted((rows[k][0] or 0, *v) for k, v in wanted.items())
    assert [g[:4] for g in got] == [p[:4] for p in plain]
    for g, p in zip(got, plain):
        assert g[4:] == pytest.approx(p[4:], abs=1e-9)
    assert katz.score_documents(docs.limit(0)).count() == 0
    untaught = katz.score_documents(docs.withColumn("held_out", docs.doc_id.isNull() | docs.doc_id.isNotNull()))
    assert {r.score for r in untaught.collect()} == {0.0}


def test_discounts_are_good_turing_or_absolute():
    n = [0, 1000, 400, 220, 140, 100, 75]
    d = katz.discounts(n)
    tail = 6 * 75 / 1000
    assert d[1] == pytest.approx((2 * 400 / 1000 - tail) / (1 - tail)) and all(0 < x < 1 for x in d[1:])
    assert all(0 < x < 1 for x in katz.discounts([0, 5, 0, 0, 0, 0, 0])[1:])


def test_op8_held_out_accuracy(spark, documents):
    truth = {r[0]: r[1] for r in documents.select("doc_id", "lang").collect()}
    got = queries.op8_language_id(spark, FOLDER).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_language_edge_rows(spark):
    rows = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), (None, "le chat"), ("fr", None)] * 2
    model = languages.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert model.langs == ["de", "en"]
    texts = [(1, None, 0.1), (2, "", 0.1), (3, "12 ?!", 0.1), (4, "THE DOG", 0.1), (5, "hund" * 9000, 0.1), (None, "die", 0.1), (4, "THE DOG", 0.1)]
    out = languages.identify(spark.createDataFrame(texts, "doc_id long, text string, score double"), model).collect()
    assert [r.lang_pred for r in out] == ["und", "und", "und", "en", "de", "de", "en"]
    nothing = languages.fit(spark.createDataFrame(rows[2:4], "lang string, text string"))
    assert nothing.predict(["the dog"]) == [("und", 0.0)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert languages.identify(empty, model).count() == 0


def test_unseen_words_go_by_their_longest_known_grams(spark):
    rows = [("aa", "brimo brimu"), ("bb", "stelta stelti")]
    model = languages.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert [x[0] for x in model.predict(["brime", "stelto", "zz"])][:2] == ["aa", "bb"]


def test_a_language_of_one_short_document_wins_its_own_text_only(spark, documents):
    rows = [(r.lang, r.text) for r in documents.where("lang is not null and text is not null").collect()]
    tiny = "qorva zelim takku dorr vispa hulan mertto oskil yaddu penzor"
    for own in (tiny, " ".join(rows[0][1].split()[:10])):
        model = languages.fit(spark.createDataFrame([*rows, ("xx", own)], "lang string, text string"))
        got = [x[0] for x in model.predict([text for _, text in rows])]
        assert np.mean([g == lang for g, (lang, _) in zip(got, rows)]) > 0.97
        assert model.predict([own])[0][0] == "xx"


def judged_by_dictionaries(rows, texts):
    """{language: its share} of each text, from all counts of rows of (lang, text)."""
    words, grams = defaultdict(Counter), defaultdict(Counter)
    for lang, text in rows:
        words[lang].update(languages.letter_words(text))
    for lang, own in words.items():
        for word in own:
            for order in languages.ORDERS:
                grams[lang, order].update(languages.grams(word, order))

    def logs(tables, item):
        most = max(sum(t.values()) for t in tables)
        floor = math.log(languages.FLOOR / (most + 1))
        return np.array([math.log((t[item] + languages.FLOOR) / (sum(t.values()) + 1)) if item in t else floor for t in tables])

    langs = sorted(words)
    for text in texts:
        total, split = np.zeros(len(langs)), languages.letter_words(text)
        for word in split:
            tables = [words[lang] for lang in langs]
            if any(word in t for t in tables):
                total += logs(tables, word)
                continue
            for order in languages.ORDERS:
                tables = [grams[lang, order] for lang in langs]
                known = [logs(tables, g) for g in languages.grams(word, order) if any(g in t for t in tables)]
                if known:
                    total += np.mean(known, axis=0)
                    break
        share = np.exp((total - total.max()) * min(1.0, languages.ENOUGH / max(1, len(split))))
        yield dict(zip(langs, share / share.sum()))


@pytest.mark.parametrize("most", [0, 3, 200_000])
def test_languages_by_all_counts(spark, monkeypatch, most):
    """Whatever is broadcast and however the blocks are cut, every count has its part."""
    monkeypatch.setattr(languages, "MAX_WORDS", most)
    monkeypatch.setattr(languages, "BLOCK_WORDS", 5)
    rows = [("aa", "bri bri bri mo mo stel trak"), ("bb", "stel stel ti ti ti ooma bri"), ("cc", "élan трак a")] * 2 + [("cc", "uurk")]
    texts = ["bri mo", "stel ti trak", "uurk uurx", "bre b ✓ xq", "élam трaк", "a a a a bri", "bri ti " * 40, "w", "ooms oom mo"]
    model = languages.fit(spark.createDataFrame(rows, "lang string, text string"))
    for shares, (lang, share) in zip(judged_by_dictionaries(rows, texts), model.predict(texts)):
        assert share == pytest.approx(shares[lang], abs=1e-9) and share == pytest.approx(max(shares.values()), abs=1e-9)


def test_a_large_language_takes_no_word_of_a_small_one(spark):
    """A language of 210,000 words that occur twice beside one whose words occur once."""
    digits = str.maketrans("0123456789", "abcdefghij")
    word = lambda i: str(i).translate(digits)
    large = [("aa", " ".join(word(i) for i in range(a, a + 1000) if i % 10)) for a in range(100_000, 333_000, 1000)] * 2
    small = " ".join(word(i) for i in range(100_000, 300_000, 5_000))
    model = languages.fit(spark.createDataFrame([*large, ("bb", small)], "lang string, text string").repartition(4))
    assert [x[0] for x in model.predict([small, large[7][1]])] == ["bb", "aa"]


def test_op7_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op7_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    held = [r for r in labels if got[r.doc_id].held_out]
    assert np.mean([got[r.doc_id].predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_quality_edge_rows(spark):
    rows = [(1, None, 3), (2, "", 3), (3, "Fine words here.", 3), (None, "###!! " * 20000, 3), (3, "Fine words here.", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    measured = quality.measure(docs)
    assert measured.where("exists(statistics, x -> isnan(x) or x is null)").count() == 0
    labels = spark.createDataFrame([(3, 1), (3, 1), (2, 0), (1, None), (9, 0), (1, 7)], "doc_id long, quality int")
    model = quality.fit(measured, labels)
    out = quality.score(measured, model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    none = quality.fit(measured, labels.limit(0))
    assert {r.score for r in quality.score(measured, none).collect()} == {0.5}
    assert quality.measure(docs.limit(0)).count() == 0


def test_short_words_and_repeats_are_counted():
    import pyarrow as pa

    place = quality.STATISTICS.index
    rows = quality.statistics(pa.array(["a bb ccc dddd", "dddd eeee\nffff", "x x x x", ""]))
    odds = lambda part, whole: np.log((part + 0.2) / (whole - part + 2.0))
    assert rows[:, place("short_words")] == pytest.approx([odds(3, 4), odds(0, 3), odds(4, 4), odds(0, 0)])
    assert rows[:, place("repeated_words")] == pytest.approx([odds(0, 4), odds(0, 3), odds(3, 4), odds(0, 0)])


def test_the_score_of_texts_is_that_of_their_statistics(spark, monkeypatch):
    """Rows do not visit Python for it, and no more than MEASURED_BYTES of text are measured at a time."""
    texts = ["A good sentence, of some length.", None, "", "# $ %% " * 90, "word word\nword word", "x" * 900] * 9
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 3 % 2) for i in range(len(texts))], "doc_id long, quality int")
    model = quality.fit(quality.measure(docs), labels)
    wanted = {r.doc_id: r.score for r in quality.score(quality.measure(docs), model).collect()}
    monkeypatch.setattr(quality, "MEASURED_BYTES", 100)
    found = docs.select("*", quality.text_score(docs["text"], model).alias("score"))
    assert {r.doc_id: r.score for r in found.collect()} == pytest.approx(wanted)
    plan = found._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
