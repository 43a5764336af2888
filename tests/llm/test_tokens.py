"""Byte-level BPE and token files against the libraries they stand for."""

import hashlib
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

from rinkflow.llm import byte_bpe, queries, token_files, workers

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = " \t\n\r \x85\x1c'sdlve re'tabcÉñ日本ش1234567890!?.,#́‍😀İΣß<|endoftext|>"


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(3)
    return ["".join(pick.choice(ALPHABET) for _ in range(pick.randint(0, 50))) for _ in range(3000)]


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word_library():
    model = tokenizers.Tokenizer.from_file(WORDS)
    model.encode_special_tokens = True
    return model


def test_byte_bpe_equals_the_library_and_inverts(texts, library):
    coder = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_byte_bpe_is_the_same_when_words_are_forgotten(texts, monkeypatch):
    coder = byte_bpe.Coder(RANKS, public_tokenizers.PATTERN)
    whole = coder.encode(texts[:200])
    monkeypatch.setattr(byte_bpe, "MEMORY_WORDS", 10)
    assert [coder.encode([t])[0] for t in texts[:200]] == whole


def test_byte_bpe_edge_rows(spark):
    rows = [(1, None, 7), (1, "", 8), (None, "a b", 9), (2, "long " * 30000, 1), (2, "long " * 30000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    out = byte_bpe.decode_documents(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert encoded.columns == ["doc_id", "n_tokens", "ids"]
    assert sorted((r.doc_id or 0, r.n_tokens, bytes(r.decoded).decode()) for r in out) == sorted(
        [(1, 0, ""), (1, 0, ""), (0, 2, "a b"), (2, 30001, "long " * 30000), (2, 30001, "long " * 30000)]
    )
    assert byte_bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_op2_over_the_table(spark, documents, library):
    got = {r[0]: tuple(r[1:]) for r in queries.op2_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in documents.select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id] == (len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest())


def test_word_encoder_equals_the_library(texts, word_library):
    encoder = token_files.WordEncoder(WORDS)
    for text, ids in zip(texts, encoder.encode(texts, 1)):
        wanted = word_library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, encoder.dtype).tolist() == [*wanted, 1]


def test_special_tokens_in_a_text_are_the_librarys():
    library = tokenizers.Tokenizer.from_file(WORDS)
    texts = ["one <|endoftext|> two", "<|startoftext|>One<|endoftext|><|endoftext|>.", "a<|endoftext|>b\nc <|endof text|>"]
    encoder = token_files.WordEncoder(WORDS)
    for text, ids in zip(texts, encoder.encode(texts)):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert 49407 in wanted and np.frombuffer(ids, encoder.dtype).tolist() == wanted


def test_file_has_equal_sequences_masks_and_documents():
    docs = [(5, np.arange(5, dtype="<u2").tobytes()), (5, b""), (None, np.arange(11, dtype="<u2").tobytes())]
    file = token_files.TokenFile(token_files.file_bytes(docs, 4, 2, "<u2", 3, 1))
    assert (file.shard, file.number, file.tokens, len(file)) == (3, 1, 16, 4)
    ids = np.concatenate([file.sequence(i)[0] for i in range(4)])
    assert ids.tolist() == [*range(5), *range(11)]
    assert all(file.sequence(i)[1].all() for i in range(4))
    assert [(d, at, x.tolist()) for d, at, x in file.documents()] == [
        (5, 0, [*range(5)]), (5, 5, []), (None, 5, [*range(11)]),
    ]
    short = token_files.TokenFile(token_files.file_bytes([(1, b"\x07\x00")], 4, 2, "<u2"))
    assert short.sequence(0)[1].tolist() == [True, False, False, False]
    empty = token_files.TokenFile(token_files.file_bytes([(1, b"")], 4, 2, "<u2"))
    assert [(d, x.tolist()) for d, _, x in empty.documents()] == [(1, [])]


def test_sequences_are_views_of_the_mapped_file(tmp_path):
    path = tmp_path / "tokens.arrow"
    path.write_bytes(token_files.file_bytes([(1, np.arange(64, dtype="<u2").tobytes())], 16, 2, "<u2"))
    ids, _ = token_files.TokenFile(str(path)).sequence(3)
    assert not ids.flags.owndata and ids.tolist() == [*range(48, 64)]


def test_token_files_edge_rows(spark, tmp_path, word_library):
    rows = [(3, "b", 1), (3, "b", 1), (3, None, 1), (None, "a b", 1), (1, "c " * 40000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int")
    folder = f"file://{tmp_path}/files"
    token_files.write_token_files(docs, folder, WORDS, end_id=1, sequence=64, file_tokens=1000)
    read = token_files.with_starts(token_files.read_token_files(spark, folder)).orderBy("start").collect()
    assert [(r.doc_id, r.n_tokens) for r in read] == [(None, 3), (1, 40001), (3, 1), (3, 2), (3, 2)] or [
        (r.doc_id, r.n_tokens) for r in read
    ] == [(None, 3), (1, 40001), (3, 2), (3, 2), (3, 1)]
    assert [r.start for r in read] == np.cumsum([0, *[r.n_tokens for r in read]])[:-1].tolist()
    token_files.write_token_files(docs.limit(0), f"file://{tmp_path}/none", WORDS)
    assert token_files.read_token_files(spark, f"file://{tmp_path}/none").count() == 0


def test_op5_over_the_table(spark, documents, word_library):
    got = {r[0]: tuple(r[1:]) for r in queries.op5_token_files(spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for doc_id, text in documents.select("doc_id", "text").orderBy("doc_id").collect():
        ids = [*word_library.encode(text or "", add_special_tokens=False).ids, 1]
        assert got[doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_a_coder_stays_for_its_own_tasks_only():
    """Later tasks of other operators in the same worker do not carry it along."""
    model = RANKS, public_tokenizers.PATTERN
    one = byte_bpe.coder(*model)
    workers.release(kept=True)
    assert byte_bpe.coder(*model) is one
    gone = weakref.ref(one)
    del one
    workers.release()
    assert gone() is None
