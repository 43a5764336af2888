"""Byte-level BPE encoding and decoding with a model serialised from a rank file."""

import base64
import os
import struct

import numpy as np
import pyarrow as pa
import regex
import sentencepiece

from rinkflow.llm.workers import keep, release, ship

#: Texts handled together in a task, in bytes, and words remembered by a worker.
BATCH_BYTES = 2 << 20
MEMORY_WORDS = 300_000


def byte_characters():
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def read_ranks(path):
    """{token bytes: rank} of a rank file (base64 token, blank, rank)."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number, value):
    """A protocol-buffer field: bytes, float or non-negative int."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialized_model(ranks):
    """A sentencepiece BPE model: piece id = rank, score = -rank, identity normalisation.

    The unknown piece, which byte-mapped text never needs, follows the ranks.
    """
    letters = byte_characters()
    size = max(ranks.values(), default=-1) + 1
    by_rank = {rank: token for token, rank in ranks.items()}
    normal, unknown, unused = 1, 2, 5
    pieces = []
    for rank in range(size):
        token = by_rank.get(rank)
        text = "".join(letters[b] for b in token) if token is not None else f"Ѐ{rank}"
        kind = normal if token is not None else unused
        pieces.append(_field(1, text.encode()) + _field(2, float(-rank)) + _field(3, kind))
    pieces.append(_field(1, "Ѐunk".encode()) + _field(2, 0.0) + _field(3, unknown))
    minus_one = (1 << 64) - 1
    trainer = _field(3, 2) + _field(4, size + 1) + _field(40, size)
    trainer += b"".join(_field(number, minus_one) for number in (41, 42, 43))
    trainer += _field(45, "Ѐunk".encode())
    normalizer = _field(1, b"identity") + b"".join(_field(number, 0) for number in (3, 4, 5))
    return b"".join(_field(1, piece) for piece in pieces) + _field(2, trainer) + _field(3, normalizer)


class Coder:
    """Encoder and decoder of one rank file and pattern; remembers words, bounded."""

    def __init__(self, path, pattern):
        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.letters = byte_characters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialized_model(self.ranks))
        # Inverse mapping of the pieces the model itself holds.
        back = {c: b for b, c in enumerate(self.letters)}
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size() - 1))
        self.tokens = [bytes(back[c] for c in p) if p[:1] in back else b"" for p in pieces]
        self.memory = {}
        self.odd_space = regex.compile(r"\s ")
        self.cut = regex.compile(r"(?<=\S) ")

    def pieces(self, words):
        """The ids (little-endian 32-bit) of each word, every match of the pattern on its own."""
        spans, todo = [], []
        for word in words:
            tokens = [t.encode() for t in self.pattern.findall(word)]
            spans.append(tokens)
            todo += [t for t in tokens if t not in self.ranks]
        todo = list(dict.fromkeys(todo))
        mapped = ["".join([self.letters[b] for b in t]) for t in todo]
        found = dict(zip(todo, self.model.encode(mapped, num_threads=1))) if todo else {}
        return [
            np.array([i for t in tokens for i in ([self.ranks[t]] if t in self.ranks else found[t])], "<u4").tobytes()
            for tokens in spans
        ]

    def split(self, text):
        """The text in words that start with a blank, but for the first.

        A blank after a character that is no white space always starts a match
        of the pattern, so words can be encoded apart.
        """
        if self.odd_space.search(text):
            ends = [m.start() for m in self.cut.finditer(text)]
            return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]

    def encode(self, texts):
        """Each text's ids as little-endian 32-bit bytes."""
        split = [self.split(t) for t in texts]
        if len(self.memory) > MEMORY_WORDS:
            self.memory.clear()
        new = list(set().union(*split).difference(self.memory))
        self.memory.update(zip(new, self.pieces(new)))
        get = self.memory.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def decode(self, ids):
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def coder(path, pattern):
    """The worker's coder for this file, made once and kept until a task of another operator ends."""
    return keep((path, os.path.getmtime(path), pattern), lambda: Coder(path, pattern))


def _runs(sizes, most):
    """(from, to) of runs of rows with about ``most`` bytes."""
    at, total = 0, 0
    for i, size in enumerate(sizes):
        if i > at and total + size > most:
            yield at, i
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield at, len(sizes)


def encode_documents(docs, path, pattern, id_column="doc_id", text_column="text"):
    """One row per document: id, n_tokens, ids (binary, little-endian unsigned 32-bit).

    Every match of ``pattern`` is encoded by itself, whole texts, no special
    tokens. Null texts count as empty (no ids). Repeated rows and null ids stay
    as they are, other columns are ignored, an empty table gives none. Texts
    go through in runs of about 2 MB, or one by one if longer. The rank file
    must be at ``path`` on every executor.
    """

    def run(batches):
        code = coder(path, pattern)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b in _runs([len(x.as_buffer()) for x in texts], BATCH_BYTES):
                ids = code.encode(texts.slice(a, b - a).to_pylist())
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), counts, pa.array(ids, pa.binary())],
                    names=[id_column, "n_tokens", "ids"],
                )
        release(kept=True)

    ship(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"`{id_column}` {kind}, n_tokens long, ids binary")


def decode_documents(encoded, path, pattern, id_column="doc_id"):
    """The rows of ``encode_documents`` with the decoded bytes in ``decoded``.

    Null ids decode to null. Decoding inverts the byte mapping of each piece.
    """

    def run(batches):
        code = coder(path, pattern)
        for batch in batches:
            ids = batch.column(2)
            for a, b in _runs([len(x.as_buffer() or b"") if x.is_valid else 0 for x in ids], BATCH_BYTES):
                part = batch.slice(a, b - a)
                texts = [None if x is None else code.decode(x) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.binary())],
                    names=[id_column, "n_tokens", "ids", "decoded"],
                )
        release(kept=True)

    ship(encoded.sparkSession)
    kind = encoded.schema[id_column].dataType.simpleString()
    return encoded.select(id_column, "n_tokens", "ids").mapInArrow(
        run, f"`{id_column}` {kind}, n_tokens long, ids binary, decoded binary"
    )
