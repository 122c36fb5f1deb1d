"""Substring deduplication against a plain count of windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from thermalis.llm import substring_dedup as sub


def brute(rows, window=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        for i in range(len(w) - window + 1):
            if doc is not None:
                key = tuple(w[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def rows_with_passages():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "İx", "a\x1cb", "a b", "日本"]
    passages = [" ".join(rng.choices(vocabulary, k=k)) for k in (10, 13, 30, 60)]
    rows = []
    for doc in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))))
            if rng.random() < 0.6:
                parts.append(rng.choice(passages))
        rows.append((doc * 3 - 20, rng.choice([" ", "\n", "\t \r\n"]).join(parts)))
    rows += [(9000, rows[7][1]), (9001, rows[7][1]), (9001, rows[7][1]), (9002, None), (9003, ""), (9004, "x " * 40),
             (9005, "x " * 40), (None, rows[7][1]), (-500, passages[3] + " " + "y " * 30000)]
    return rows


@pytest.mark.parametrize("hot", [2000, 3])
def test_against_brute_force(spark, hot):
    rows = rows_with_passages()
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, home int, words string")
    found = sub.remove_repeats(docs.repartition(4), hot=hot)
    got = found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))


def test_empty_table(spark):
    assert sub.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
