"""Corpus pipeline: stages over documents, each written as Parquet and read again by the next.

A stage gets all rows that its predecessor kept and returns those it keeps,
with the columns of documents; the last one returns the token ids.
"""

from functools import reduce
from operator import and_

import public_tokenizers
from pyspark.sql import functions as F

from rinkflow.llm import byte_bpe, decontamination, languages, near_copies, quality
from rinkflow.session import materialize

#: Share of the likeliest language, and probability of good quality, below which a document goes.
LEAST_SHARE = 0.5
LEAST_QUALITY = 0.5


def _hidden(docs):
    """``docs`` under private column names, so that what operators add can clash with none; and the names."""
    names = {c: f"_column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _shown(hidden, names):
    return hidden.select(*[F.col(own).alias(c) for c, own in names.items()])


def _without(docs, gone, on):
    """``docs`` without the rows whose values of the columns ``on`` equal a row of ``gone``, nulls equal to nulls.

    The list is broadcast if it is short; the documents then stay where they are.
    """
    gone = materialize(gone.toDF(*[f"_gone_{i}" for i in range(len(on))]).distinct())
    if gone.count() <= near_copies.FEW_IDS:
        gone = F.broadcast(gone)
    same = [c.eqNullSafe(gone[f"_gone_{i}"]) for i, c in enumerate(on)]
    return docs.join(gone, reduce(and_, same), "left_anti")


def language_id(spark, docs, sf_dir):
    """Keeps documents whose language is told with at least LEAST_SHARE; learns from all that name one.

    Null, empty and letterless texts go (no language can be told), repeated rows are
    judged alike, and columns of any name stay as they are. Only ids and text hashes come
    back from the judging, so that no text travels with the blocks.
    """
    model = languages.fit(docs)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    judged = languages.identify(rows, model, ("doc_id", "text_key"))
    told = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)
    gone = judged.where(~told).select("doc_id", "text_key")
    return _without(docs, gone, [docs["doc_id"], F.xxhash64(docs["text"])])


def quality_classifier(spark, docs, sf_dir):
    """Keeps documents of a quality of at least LEAST_QUALITY; learns from all labelled ones.

    A null text counts as empty, repeated rows are judged alike, rows without an id teach
    nothing, and columns of any name stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ids = labels.select("doc_id").distinct()
    ids = F.broadcast(ids) if ids.count() <= near_copies.FEW_IDS else ids
    taught = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    model = quality.fit(quality.measure(taught), labels)
    hidden, names = _hidden(docs)
    return _shown(hidden.where(quality.text_score(hidden[names["text"]], model) >= LEAST_QUALITY), names)


def near_dedup(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near copies: five-word shingles, 80 percent.

    Texts without words are in no group and stay, so do rows without an id. Rows that
    share an id go by their own texts; of those of one id in one group one row stays,
    that of the smallest text hash.
    """
    found = materialize(near_copies.near_copies(docs))
    key = F.xxhash64(docs["text"])
    kept = _without(docs, found.where("not kept").select("doc_id", "text_key"), [docs["doc_id"], key])
    group = ["doc_id", "component_key"]
    several = found.where("kept and doc_id is not null").groupBy(*group).agg(
        F.count("*").alias("n"), F.min("text_key").alias("text_key")
    )
    several = materialize(several.where("n > 1").drop("n"))
    if several.isEmpty():
        return kept
    copies = found.join(several.select(*group), group, "left_semi").select("doc_id", "text_key")
    once = _without(kept, copies, [docs["doc_id"], key])
    hidden, names = _hidden(docs.dropDuplicates())
    chosen = several.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    same = (hidden[names["doc_id"]] == F.col("_id")) & (F.xxhash64(names["text"]) == F.col("_key"))
    rows = hidden.join(chosen, same, "left_semi").dropDuplicates([names["doc_id"], names["text"]])
    return once.unionByName(_shown(rows, names))


def benchmark_decontamination(spark, docs, sf_dir):
    """Keeps documents that hold no benchmark item.

    Null and empty texts hold none; rows that repeat an id go by their own texts.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contaminated(docs.select("doc_id", "text"), items).select("doc_id", "text_key")
    return _without(docs, found, [docs["doc_id"], F.xxhash64(docs["text"])])


def byte_level_bpe(spark, docs, sf_dir):
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the digest of what they decode to.

    A null text counts as empty; repeated rows come out repeated. The ids are written before they
    are decoded, so that a task keeps one Python worker, not two.
    """
    model = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = materialize(byte_bpe.encode_documents(docs, *model))
    decoded = byte_bpe.decode_documents(encoded, *model)
    return decoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL cannot express the classifiers; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
