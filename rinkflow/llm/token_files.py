"""Token ids in Arrow files of equal-length sequences with masks, written and read by Spark.

A file holds record batches of ``batch_sequences`` rows (the last may be
shorter) with three columns:

- ids: fixed-size list of ``sequence`` unsigned integers (16 bits if the
  vocabulary fits, else 32), documents one after another, padded with zeros;
- mask: fixed-size list of ``sequence`` booleans, true where ids are real;
- docs: list of struct<doc_id, begin, length, ends>, the pieces of documents in it.

Sequence i of a file is row ``i % batch_sequences`` of batch
``i // batch_sequences``; its ids and mask are views of the mapped file, not
copies. Files are in order of (shard, number), kept in the schema's metadata;
a document never spans files.
"""

import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from rinkflow.llm.words import column_bytes
from rinkflow.llm.workers import ship

#: Words remembered by a worker, texts handled together in bytes.
MEMORY_WORDS = 600_000
BATCH_BYTES = 2 << 20
#: The closing bytes of every Arrow file; written as the text writer's row separator.
MAGIC = b"ARROW1"

_encoders = {}


class WordEncoder:
    """A tokenizers file whose words end at blanks and line ends; remembers words, bounded.

    Blanks and line ends are white space that the tokenizer drops, so the
    words between them are encoded apart and each distinct one once.
    """

    #: One pre-token, or two: letters that neither case nor normalisation changes
    #: in number, then ASCII marks.
    SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%&*$#|]*)")

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        size = self.model.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for token, i in self.model.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.memory = {}

    def _one(self, word):
        return np.array(self.model.encode(word, add_special_tokens=False).ids, self.dtype).tobytes()

    def _line(self, words, counts):
        """The ids of simple words from one call: every pre-token ends with an id that says so."""
        ids = np.array(self.model.encode(" ".join(words), add_special_tokens=False).ids, self.dtype)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != sum(counts):
            return [self._one(w) for w in words]
        cuts = [0, *ends[np.cumsum(counts) - 1].tolist()]
        return [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def learn(self, words):
        simple, counts = [], []
        for word in words:
            m = self.SIMPLE.fullmatch(word)
            if m:
                simple.append(word)
                counts.append(1 + bool(m[2]))
            else:
                self.memory[word] = self._one(word)
        for a in range(0, len(simple), 200):
            part = simple[a : a + 200]
            self.memory.update(zip(part, self._line(part, counts[a : a + 200])))

    def encode(self, texts, end_id=None):
        """Each text's ids as bytes of ``self.dtype``, the end id appended."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.memory) > MEMORY_WORDS:
            self.memory.clear()
        self.learn(set().union(*split).difference(self.memory))
        get = self.memory.__getitem__
        end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        return [b"".join(map(get, words)) + end for words in split]


def word_encoder(path):
    key = (path, os.path.getmtime(path))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(path)
    return _encoders[key]


def file_bytes(docs, sequence, batch_sequences, dtype, shard=0, number=0):
    """The Arrow file of [(doc_id, ids as bytes of dtype)]."""
    dtype = np.dtype(dtype)
    lengths = np.array([len(ids) // dtype.itemsize for _, ids in docs], np.int64)
    total = int(lengths.sum())
    rows = max(1, -(-total // sequence))
    ids = np.zeros(rows * sequence, dtype)
    ids[:total] = np.frombuffer(b"".join(x for _, x in docs), dtype)
    mask = np.arange(rows * sequence) < total
    pieces = [[] for _ in range(rows)]
    at = 0
    for (doc_id, _), length in zip(docs, lengths.tolist()):
        left = length
        while True:
            row = min(at // sequence, rows - 1)
            part = min(left, (row + 1) * sequence - at)
            pieces[row].append({"doc_id": doc_id, "begin": at - row * sequence, "length": part, "ends": part == left})
            at, left = at + part, left - part
            if not left:
                break
    kind = pa.struct([("doc_id", pa.int64()), ("begin", pa.int32()), ("length", pa.int32()), ("ends", pa.bool_())])
    columns = {
        "ids": pa.FixedSizeListArray.from_arrays(pa.array(ids), sequence),
        "mask": pa.FixedSizeListArray.from_arrays(pa.array(mask), sequence),
        "docs": pa.array(pieces, pa.list_(kind)),
    }
    facts = {"shard": shard, "number": number, "tokens": total, "batch_sequences": batch_sequences}
    whole = pa.table(columns).replace_schema_metadata({k: str(v) for k, v in facts.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, whole.schema) as writer:
        writer.write_table(whole, max_chunksize=batch_sequences)
    return sink.getvalue().to_pybytes()


class TokenFile:
    """Random access to a file: a path (memory-mapped) or its bytes."""

    def __init__(self, source):
        source = pa.memory_map(source) if isinstance(source, str) else pa.BufferReader(source)
        self.file = pa.ipc.open_file(source)
        facts = {k.decode(): int(v) for k, v in self.file.schema.metadata.items()}
        self.shard, self.number, self.tokens = facts["shard"], facts["number"], facts["tokens"]
        self.batch_sequences = facts["batch_sequences"]
        self.length = self.file.schema.field("ids").type.list_size

    def __len__(self):
        return max(1, -(-self.tokens // self.length))

    def sequence(self, i):
        """(ids, mask) of sequence i; ids are a view of the file."""
        batch = self.file.get_batch(i // self.batch_sequences)
        at = i % self.batch_sequences
        return batch.column(0)[at].values.to_numpy(), batch.column(1)[at].values.to_numpy(zero_copy_only=False)

    def documents(self):
        """(doc_id, place of its first id in the file, ids) in order; empty documents included."""
        parts, first, rows = [], 0, 0
        for b in range(self.file.num_record_batches):
            batch = self.file.get_batch(b)
            flat = batch.column(0).flatten().to_numpy()
            for row, pieces in enumerate(batch.column(2).to_pylist()):
                for piece in pieces:
                    at = row * self.length + piece["begin"]
                    if not parts:
                        first = rows * self.length + at
                    parts.append(flat[at : at + piece["length"]])
                    if piece["ends"]:
                        yield piece["doc_id"], first, np.concatenate(parts)
                        parts = []
            rows += len(batch)


def write_token_files(
    docs, folder, path, end_id=None, sequence=2048, batch_sequences=256, file_tokens=16 << 20,
    id_column="doc_id", text_column="text",
):
    """Encode whole texts and write them to ``folder`` in ascending order of the id.

    ``path`` names a tokenizers file on every executor; special tokens' strings
    in a text are ordinary text; ``end_id`` is appended to each document.
    A null text counts as empty; null ids come first, repeated ids in order of
    their texts; other columns are ignored; an empty table gives no file.
    Texts are dealt out by ranges of the id, so a task holds one file of about
    ``file_tokens`` ids (one long document may exceed it). Files go through
    Spark's committer: a task that is lost leaves nothing behind.
    """
    spark = docs.sparkSession
    ship(spark)
    ordered = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )

    def run(batches):
        encoder = word_encoder(path)
        shard, number = TaskContext.get().partitionId(), 0
        held, size = [], 0
        most = file_tokens * encoder.dtype.itemsize
        for batch in batches:
            texts = batch.column(1).fill_null("")
            sizes = np.diff(column_bytes(batch.column(1))[1])
            cuts, total = [0], 0
            for i, n in enumerate(sizes.tolist()):
                if total and total + n > BATCH_BYTES:
                    cuts.append(i)
                    total = 0
                total += n
            for a, b in zip(cuts, [*cuts[1:], len(sizes)]):
                ids = encoder.encode(texts.slice(a, b - a).to_pylist(), end_id)
                for doc in zip(batch.column(0).slice(a, b - a).to_pylist(), ids):
                    if held and size + len(doc[1]) > most:
                        yield _row(file_bytes(held, sequence, batch_sequences, encoder.dtype, shard, number))
                        held, size, number = [], 0, number + 1
                    held.append(doc)
                    size += len(doc[1])
        if held:
            yield _row(file_bytes(held, sequence, batch_sequences, encoder.dtype, shard, number))

    files = ordered.mapInArrow(run, "bytes binary")
    files.select(F.col("bytes").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "lineSep", MAGIC.decode()
    ).text(folder)


def _row(content):
    """A file's bytes without the closing magic, which the writer adds as the row's separator."""
    return pa.RecordBatch.from_arrays([pa.array([content[: -len(MAGIC)]], pa.binary())], names=["bytes"])


def read_token_files(spark, folder):
    """One row per document: shard, number, doc_id, place (of its first id in the file),
    n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    ship(spark)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                file = TokenFile(content.as_buffer())
                rows, size = [], 0
                for doc_id, place, ids in file.documents():
                    rows.append((file.shard, file.number, doc_id, place, len(ids), ids.astype("<u4").tobytes()))
                    size += 4 * len(ids)
                    if size > 4 * BATCH_BYTES:
                        yield _documents(rows)
                        rows, size = [], 0
                if rows:
                    yield _documents(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(run, "shard long, number long, doc_id long, place long, n_tokens long, ids binary")


def _documents(rows):
    names = ["shard", "number", "doc_id", "place", "n_tokens", "ids"]
    kinds = [pa.int64()] * 5 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)


def with_starts(documents):
    """Rows of ``read_token_files`` (stored, as they are used twice) with ``start``: ids before them in all files.

    The running total is over one row per file.
    """
    totals = documents.groupBy("shard", "number").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("shard", "number", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return documents.join(starts, ["shard", "number"]).withColumn("start", F.col("before") + F.col("place"))
