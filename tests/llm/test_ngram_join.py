"""The join against all pairs."""

import random
import re
from pathlib import Path

import numpy as np
import pytest

from thermalis.llm import ngram_join
from thermalis.sources import durable


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, k=4, part=85, whole=100):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets[doc] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and whole * both >= part * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((d, len(s), root(d)) for d, s in sets.items())


def groups():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["Été", "a b", "the", "THE"]
    common = " ".join(rng.choices(vocabulary, k=12))
    rows = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 40, 120]))
        for _ in range(rng.randint(1, 12)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 + 3, rng.choice([" ", "\n", "  \t"]).join(words) + (" " + common if rng.random() < 0.3 else "")))
    chain = [f"c{i}" for i in range(130)]
    rows += [(5000 + i, " ".join(chain[i * 2:i * 2 + 100])) for i in range(14)]
    return rows + [(9000, None), (9001, ""), (9002, "one two"), (9003, "One  two"), (9004, "one"), (9005, "z " * 30000)]


def test_against_all_pairs(spark):
    rows = groups()
    random.Random(4).shuffle(rows)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, rep string")
    got = sorted(tuple(r) for r in ngram_join.cluster(docs.repartition(5)).collect())
    assert got == brute(rows)
    got = sorted(tuple(r) for r in ngram_join.cluster(docs, k=5, part=80).collect())
    assert got == brute(rows, 5, 80)


def test_null_ids_repeats_and_an_empty_table(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e"), (None, "a b c d e"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(repr, map(tuple, ngram_join.cluster(docs).collect())))
    assert got == sorted(["(1, 2, 1)", "(1, 2, 1)", "(2, 2, 1)", "(None, 2, None)", "(4, 0, 4)"])
    assert ngram_join.one_of_each(docs).columns == docs.columns
    assert ngram_join.cluster(docs.limit(0)).collect() == []


def test_sketches_never_overstate_the_difference():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 64, 6000, np.uint64)
    for n, m in ((0, 5), (1, 1), (31, 33), (40, 3000), (900, 1000), (2500, 2600)):
        a, b = np.unique(rng.choice(pool, n, False)), np.unique(rng.choice(pool, m, False))
        true = len(np.setxor1d(a, b))
        if n:
            assert ngram_join.least_difference(ngram_join.sketch(a), ngram_join.sketch(b)) <= true
            assert ngram_join.least_difference(ngram_join.sketch(a), ngram_join.sketch(a)) == 0


def test_turns_and_list_lengths_change_nothing(spark, monkeypatch):
    rows = groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for turns, short, later, most in ((0, 1, 1, 3), (2, 2, 4, 12)):
        for name, value in (("TURNS", turns), ("SHORT", short), ("LATER", later), ("MOST", most)):
            monkeypatch.setattr(ngram_join, name, value)
        assert sorted(tuple(r) for r in ngram_join.cluster(docs).collect()) == want


def test_many_variants_of_one_text_that_do_not_link(spark, monkeypatch):
    """All share most shingles with all, but only those of one variant link: no list may be compared pair by pair."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for v in range(40):
        variant = list(base)
        for i in rng.sample(range(120), 5):
            variant[i] = f"v{v}x{i}"
        for c in range(4):
            words = list(variant)
            words[rng.randrange(120)] = f"c{v}x{c}"
            rows.append((len(rows), " ".join(words)))
    made = []
    plain = ngram_join.short_pairs
    monkeypatch.setattr(ngram_join, "short_pairs", lambda *a: made.append(plain(*a)) or made[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.cluster(docs).collect()) == brute(rows)
    assert sum(df.count() for df in made) < 8 * len(rows)


def test_names_that_clash(spark):
    rows = [(1, "a b c d e f", 1, 2), (2, "a b c d e f", 1, 2), (None, "a b c d e f", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id int, component_id int")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1]


def test_lines_that_many_texts_have_make_no_pairs(spark, monkeypatch):
    """Texts of unlike words with the same lines in them: places and counts of common shingles rule their pairs out."""
    rng = random.Random(2)
    lines = [f"the line {i} again" for i in range(10)]
    rows = []
    for d in range(80):
        words = [f"t{d}x{i}" for i in range(50)]
        rows.append((d, " ".join(f"{line} {' '.join(words[5 * i:5 * i + 5])}" for i, line in enumerate(rng.sample(lines, 10)))))
    rows += [(200 + d, rows[d][1] + " more") for d in range(0, 80, 8)]
    made = []
    plain = ngram_join.short_pairs
    monkeypatch.setattr(ngram_join, "short_pairs", lambda *a: made.append(plain(*a)) or made[-1])
    for name, value in (("ORDERED", 1), ("TURNS", 0), ("SHORT", 1000)):
        monkeypatch.setattr(ngram_join, name, value)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.cluster(docs).collect()) == brute(rows)
    assert 10 <= sum(df.count() for df in made) < 30


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 40 partitions that are not joined."""
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_the_bit_map_comes_in_one_job(spark, many_partitions):
    context = spark.sparkContext
    wanted = spark.createDataFrame([(i,) for i in range(0, 3000, 3)], "rep long")
    context.setJobGroup("bit-map", "bit map")
    table = np.unpackbits(np.frombuffer(ngram_join.bit_map(wanted, 16).value, np.uint8), bitorder="little")
    context.setLocalProperty("spark.jobGroup.id", None)
    places = {r.place for r in wanted.select(ngram_join.place_of("rep", 16)).collect()}
    assert set(np.flatnonzero(table).tolist()) == places
    assert not np.any(np.frombuffer(ngram_join.bit_map(wanted.limit(0), 16).value, np.uint8))
    assert len(context.statusTracker().getJobIdsForGroup("bit-map")) <= 5


def test_small_tables_are_few_files(spark, many_partitions, tmp_path, monkeypatch):
    rows = groups()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(durable, "scratch_root", lambda spark: str(tmp_path))
    got = sorted(tuple(r) for r in ngram_join.cluster(docs.repartition(5)).collect())
    assert got == brute(rows)
    files = {table.name[:-33]: len(list(table.glob("part-*"))) for table in Path(tmp_path).iterdir()}
    assert "labels" in files and max(files.values()) <= max(5, spark.sparkContext.defaultParallelism), files
