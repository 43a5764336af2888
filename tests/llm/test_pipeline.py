"""The stages of the pipeline against what they should keep; registered SQL against its queries."""

import corpus_pipeline
import pytest
import tiktoken
from check_queries import cell, duck, normalized
from pyspark.sql import functions as F
from test_copies import groups

from rinkflow.llm import byte_bpe, decontamination, languages, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    theirs = duck(FOLDER).sql(queries.SQL[name])
    assert normalized(df.columns, [tuple(r) for r in df.collect()]) == normalized(theirs.columns, theirs.fetchall())
    assert cell(None) == "NULL"


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = [*entry.queries()]
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = before, {r.doc_id for r in docs.collect()}
    before, after = kept["language_id"]
    assert len(after) > 0.98 * len(before)
    before, after = kept["quality_classifier"]
    known = [i for i in before if i in labels]
    assert sum((i in after) == bool(labels[i]) for i in known) > 0.95 * len(known)
    before, after = kept["near_dedup"]
    assert after == {c for _, c in groups([*before.items()], 5, 80).values()}
    before, after = kept["benchmark_decontamination"]
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rows = spark.createDataFrame([*before.items()], "doc_id long, text string")
    assert before.keys() - after == {r.doc_id for r in decontamination.contaminated(rows, items).collect()}
    out = corpus_pipeline.byte_level_bpe(spark, docs, FOLDER).collect()
    import public_tokenizers

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert {r.doc_id: r.n_tokens for r in out} == {i: len(library.encode_ordinary(before[i])) for i in after}


def test_edge_rows(spark):
    """Nulls, empty and repeated rows go through every stage."""
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "the words of the text and more words", "en", "s", 9), (3, "the words of that text", "en", "s", 9), (3, "the words of that text", "en", "s", 9), (4, "der Hund und die Katze", "de", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER))
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.columns == docs.columns and empty.count() == 0
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(3) == 1 and 1 not in ids and 2 not in ids
    assert corpus_pipeline.byte_level_bpe(spark, docs, FOLDER).count() == len(ids)


def test_columns_of_any_name_stay(spark):
    """Extra columns named like what the stages compute come out as they were."""
    extra = {"score": -7.0, "lang_pred": "x", "statistics": "s", "predicted": 3, "text_key": 5, "component_id": 6, "kept": "k", "_gone_0": 9}
    rows = [(i, f"the words of a text and more words of number {i} in the house", "en", "s", 9, *extra.values()) for i in range(6)]
    columns = ["doc_id", "text", "lang", "source", "n_chars", *extra]
    docs = spark.createDataFrame(rows, columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, FOLDER))
        assert out.columns == columns, name
        assert {tuple(r)[5:] for r in out.collect()} <= {tuple(extra.values())}, name


def test_an_id_with_several_texts_keeps_one_row_of_a_group(spark):
    words = [f"w{i}" for i in range(63)]
    rows = [(1, " ".join(words)), (1, " ".join([*words[:-1], "x"])), (1, "another text of its own with words"), (2, " ".join(words)), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect())
    assert len(kept) == 3 and (3, "") in kept
    assert sum(k[0] == 1 and k[1].startswith("w0") for k in kept) == 1 and (1, rows[2][1]) in kept


def test_language_id_brings_no_text_back_from_python(spark, monkeypatch):
    """Ids and text hashes come back; rows that share an id, or have none, go or stay by their own texts."""
    asked, identify = [], languages.identify

    def noted(docs, model, columns, *names):
        asked.extend(columns)
        return identify(docs, model, columns, *names)

    monkeypatch.setattr(languages, "identify", noted)
    rows = [(1, "the words of the text"), (1, "12 34"), (None, "the words"), (None, "56"), (2, None), (3, "the text"), (3, "the text"), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.language_id(spark, docs, FOLDER).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], rows[2], rows[5], rows[6]], key=str)
    assert asked and "text" not in asked and len(asked) == 2


def test_weights_start_no_python_workers(spark):
    counts = spark.createDataFrame([("en", "the", 3), ("de", "der", 2)], "lang string, item string, n long")
    weights = languages._weights(counts.coalesce(1), {("en", 0): 3, ("de", 0): 2}, F.lit(0))
    assert {(r.item, r.place) for r in weights.collect()} == {("the", 1), ("der", 0)}
    assert weights._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1  # counts, made above
    assert languages._weights(counts, {}, F.lit(0)).isEmpty()
