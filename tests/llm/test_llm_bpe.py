import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyspark.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def exact():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("exact", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ids(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


def test_random_texts_equal_tiktoken(exact):
    rnd = random.Random(5)
    letters = "ab'sté \n\t   1²ü!?\x1c\x85日本のअनु🙂re'll<|endoftext|>"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 300))) for _ in range(1500)]
    words = bpe.vocabulary(PATH, PATTERN)
    assert [ids(x) for x in words.encode(texts)] == [exact(t) for t in texts]


def test_long_words_use_the_same_merges(exact):
    rnd = random.Random(6)
    words = bpe.vocabulary(PATH, PATTERN)
    for n in (bpe.BATCH_BYTES - 1, bpe.BATCH_BYTES, bpe.BATCH_BYTES + 1, 5000, 60000):
        word = "".join(rnd.choice("abcdetion") for _ in range(n))
        assert ids(words.encode([word])[0]) == exact(word)
    assert ids(words.merge_long(b"strawberries")) == ids(words.merge_batch([b"strawberries"], 16)[0])


def test_cache_may_be_forgotten(exact, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    words = bpe.Vocabulary(PATH, PATTERN)
    for text in ("one two three four five", "six seven", "one two three"):
        assert ids(words.encode([text])[0]) == exact(text)


def test_round_trip_of_awkward_rows(docs, clashing, no_docs, exact):
    encoded = bpe.encode(docs, PATH, PATTERN, keep=["doc_id", "text"])
    for row in bpe.decode(encoded, PATH, PATTERN, keep=["doc_id", "text", "n_tokens"]).collect():
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    for row in encoded.collect():
        assert ids(row["ids"]) == exact(row["text"] or "") and row["n_tokens"] == len(ids(row["ids"]))
    assert encoded.count() == docs.count()
    assert bpe.decode(bpe.encode(clashing, PATH, PATTERN), PATH, PATTERN).count() == docs.count()
    assert bpe.encode(no_docs, PATH, PATTERN).collect() == []
