"""Byte-level BPE against the tiktoken library."""

import pickle
import random
import tracemalloc

import public_tokenizers
import pytest
import tiktoken

from thermalis.llm import bpe
from thermalis.llm.registry import vocabulary


@pytest.fixture(scope="module")
def vocab():
    return vocabulary()


@pytest.fixture(scope="module")
def reference(vocab):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    alphabet = [" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "\xa0", " ", "a", "the", "'s", "'ll", "É", "ß", "1", "42",
                "!", "...", "<|endoftext|>", "日本", "🙂", "é", "‍", "ing", "tion", "\r\n", "\0"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(1500)]
    return texts + ["", " ", "a ", " a", "  a  b \n c", "x" * 70, "ab" * 500, "é" * 300, " " * 200, "!?" * 100]


def test_ids_are_those_of_tiktoken(vocab, reference):
    texts = odd_texts()
    coder = bpe.Encoder(vocab, cached=700)
    for start in range(0, len(texts), 97):
        part = texts[start:start + 97]
        got = [[int.from_bytes(i[k:k + 4], "little") for k in range(0, len(i), 4)] for i in coder.encode(part)]
        assert got == [reference.encode_ordinary(t) for t in part]


def test_long_and_short_trees_agree(vocab):
    rng = random.Random(1)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 60))).encode() for _ in range(300)]
    by_size = {}
    for w in words:
        by_size.setdefault(max(2, 1 << (len(w) - 1).bit_length()), []).append(w)
    for size, group in by_size.items():
        assert bpe.merge_together(vocab, group, size) == [bpe.merge_alone(vocab, w) for w in group]


def test_round_trip_with_nulls_repeats_and_clashing_columns(spark, vocab, reference):
    texts = ["", None, "the cat  sat", "the cat  sat", "x" * 100_000, "a\n\n b "]
    rows = [(i if i != 3 else 2, t, "k", 7) for i, t in enumerate(texts)] + [(None, "null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n_tokens int")
    coded = bpe.encode(docs, vocab)
    assert coded.columns == ["doc_id", "n_tokens", "ids"]
    back = bpe.decode(coded, vocab).collect()
    assert sorted(r.text_bytes.decode() for r in back) == sorted(t or "" for _, t, _, _ in rows)
    assert sorted(r.n_tokens for r in back) == sorted(len(reference.encode_ordinary(t or "")) for _, t, _, _ in rows)
    assert bpe.round_trip(docs.limit(0), vocab).count() == 0


def test_a_worker_holds_little_while_it_encodes(vocab):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(3, 16))) for _ in range(400)) for _ in range(1000)]
    coder, size = bpe.Encoder(vocab), 0
    tracemalloc.start()
    for part in bpe.slices(texts):
        size += sum(map(len, coder.encode(texts[part])))
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size and len(coder.known) <= bpe.CACHED
    assert held < 50 << 20 and peak < 90 << 20


def test_decoding_takes_along_the_pieces_alone(spark, vocab, monkeypatch):
    sent = []
    whole = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or whole(self, value))
    docs = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, vocab), vocab)
    assert bytes(back.first().text_bytes) == b"the cat"
    assert len(pickle.dumps(sent[-1], 5)) < len(pickle.dumps(vocab, 5)) / 3
