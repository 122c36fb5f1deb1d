"""Packed rows: nothing lost, best fit, resets."""

import random

import numpy as np
import tiktoken

from thermalis.llm import packing
from thermalis.llm.registry import vocabulary


def plain_best_fit(lengths, row):
    rooms, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(room, at) for at, room in enumerate(rooms) if room >= lengths[i]]
        if fits:
            room, at = min(fits)
        else:
            at, room = len(rooms), row
            rooms.append(row)
        rooms[at] = room - lengths[i]
        out[i] = at
    return rooms


def test_tree_finds_the_best_fit():
    rng = random.Random(2)
    for row in (1, 2, 7, 8, 100, 2048):
        for _ in range(20):
            lengths = [rng.randint(1, row) for _ in range(rng.randint(0, 60))]
            at = packing.best_fit(lengths, row)
            rooms = [row - sum(n for n, a in zip(lengths, at) if a == r) for r in range(max(at, default=-1) + 1)]
            assert sorted(rooms) == sorted(plain_best_fit(lengths, row)) and min(rooms, default=0) >= 0


def test_documents_come_back(spark):
    vocab = vocabulary()
    encode = tiktoken.Encoding("t", pat_str=vocab.pattern, mergeable_ranks=vocab.ranks, special_tokens={}).encode_ordinary
    rows = [(i, "the cat sat on a mat " * (i % 40), "x") for i in range(300)]
    rows += [(1000, "a b " * 5000, "y"), (1001, None, "z"), (1002, "", None), (None, "no id", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    packed = packing.write_packed(packing.pack(docs, vocab.ranks, vocab.pattern, end=50256, row=256)).collect()
    found = {}
    for r in packed:
        ids = np.frombuffer(r.ids, "<u2").tolist()
        assert len(ids) == 256 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert set(ids[r.n_tokens:]) <= {50256}
        for doc, start, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found.setdefault(doc, []).append((start, ids[a:b]))
    for doc, text, _ in rows:
        assert sum((ids for _, ids in sorted(found[doc])), []) == [*encode(text or ""), 50256]
    assert packing.pack(docs.limit(0), vocab.ranks, vocab.pattern, end=50256).collect() == []
