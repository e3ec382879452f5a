import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import documents, rows_of, texts

from fragloom.llm import byte_bpe as b

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = b.parse_ranks(open(PATH, "rb").read())


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return b.Encoder(RANKS, public_tokenizers.PATTERN)


def test_every_case_against_the_library(spark, reference):
    want = []
    for i, text in texts():
        ids = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
        raw = (text or "").encode()
        want.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest()))
    assert rows_of(b.token_digests(documents(spark), PATH, public_tokenizers.PATTERN)) == sorted(want, key=repr)


def test_encoding_and_decoding_apart_are_the_round_trip(spark):
    docs = documents(spark)
    apart = b.decode_documents(b.encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert rows_of(apart) == rows_of(b.round_trip(docs, PATH, public_tokenizers.PATTERN))


def test_no_rows(spark):
    assert b.token_digests(documents(spark, []), PATH, public_tokenizers.PATTERN).collect() == []


def test_random_texts(reference, encoder):
    rng = random.Random(1)
    some = ["".join(rng.choices("ab '\n\t.é日1😀srtvelTHE", k=rng.randint(0, 200))) for _ in range(1500)]
    some += ["".join(rng.choices("abcthe", k=n)) for n in (255, 256, 257, 513, 5000)]
    some += ["a" * 20_000, " " * 3000, "<|endoftext|>", "\x00\x01"]
    for (_, ids), text in zip(encoder.encode(enumerate(some)), some, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)


def test_blocks_and_forgetting_change_nothing(encoder, monkeypatch):
    some = [text or "" for _, text in texts()]
    want = [ids for _, ids in encoder.encode(enumerate(some))]
    monkeypatch.setattr(b, "BLOCK_PIECES", 50)
    monkeypatch.setattr(b, "KNOWN_PIECES", 60)
    monkeypatch.setattr(b, "FOREST_LEAVES", 64)
    again = b.Encoder(RANKS, public_tokenizers.PATTERN)
    assert [ids for _, ids in again.encode(enumerate(some))] == want


def test_large_rank_files_are_refused(spark, monkeypatch):
    monkeypatch.setattr(b, "MAX_RANK_BYTES", 100)
    with pytest.raises(ValueError, match="larger than"):
        b.token_digests(documents(spark), PATH, public_tokenizers.PATTERN)
