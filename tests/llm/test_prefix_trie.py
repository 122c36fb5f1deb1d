"""The trie of conversations against dictionaries."""

import hashlib
import random
import re
import zlib

from thermalis.llm import prefix_trie
from thermalis.llm.registry import op12_prefix_trie


def ordered(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(own)] for c, own in turns.items()}


def rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(turns):
    members = {}
    for c, own in turns.items():
        for d in range(len(own) + 1):
            members.setdefault(tuple(own[:d]), []).append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[:len(path)] == path]
        leaf = [p for p in below if not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in members)]
        words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in below}
        ends = sorted(c for c in convs if len(turns[c]) == len(path))
        out.append((min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs),
                    sum(len(q) == len(path) + 1 for q in below), len(leaf), sum((len(members[p]) - 1) * words[p] for p in below),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(seed):
    rng = random.Random(seed)
    texts = ["yes", "no thanks", "tell me  more", "", None, "α β γ", "\tx\ny "]
    hot = [(i, "user", rng.choice(texts)) for i in range(11)]
    rows = []
    for c in rng.sample(range(400), 90):
        own = list(hot[:rng.randint(0, 11)]) if rng.random() < 0.6 else []
        own += [(len(own) + i, rng.choice(["user", "assistant", None]), rng.choice(texts)) for i in range(rng.randint(0, 6))]
        rows += [(c, None if i == 0 and rng.random() < 0.2 else t, role, text) for i, (t, role, text) in enumerate(own)]
    for c in range(401, 430):  # each hangs on the one before
        rows += [(c, i, "user", f"step {min(i, c)}") for i in range(c - 400)] + [(c, 100, "user", f"end {c}")]
    return rows + [(None, 1, "user", "lost")]


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "k") for r in rows], "conv_id long, turn long, role string, text string, depth int, owner string")


def test_against_dictionaries(spark):
    for seed in (1, 2):
        rows = conversations(seed)
        docs = table(spark, rows).repartition(5)
        got = prefix_trie.rebuilt_trie(docs).select(COLUMNS).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rebuilt(ordered(rows)))


def test_any_block_length_gives_the_same_trie(spark):
    rows = conversations(3)
    want = [r[:7] for r in brute(ordered(rows))]
    for size in (1, 3, 50):
        nodes, ends = prefix_trie.prefix_trie(table(spark, rows), size=size)
        assert sorted((tuple(r) for r in nodes.select(COLUMNS[:7]).collect()), key=repr) == sorted(want, key=repr)
        assert ends.count() == len(ordered(rows))


def test_equal_conversations_repeated_rows_and_no_rows(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(40) for t in range(3)] + [(5, 1, "user", "t1")] * 2
    got = prefix_trie.rebuilt_trie(table(spark, rows)).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rebuilt(ordered(rows)))
    assert prefix_trie.rebuilt_trie(table(spark, rows).limit(0)).collect() == []


def test_a_hot_key_is_hashed_in_order(spark, monkeypatch):
    from thermalis.llm import common
    monkeypatch.setattr(common, "PACK", 64)
    rows = [(i % 3 == 0, i) for i in range(3000)]
    given = spark.createDataFrame([(int(k), i, str(i).encode()) for k, i in rows], "k long, i long, content binary").repartition(7)
    got = {r.k: r.sha256 for r in common.streamed_sha256(given, ["k"], "i", b",").collect()}
    assert got == {int(k): hashlib.sha256(",".join(str(i) for own, i in rows if own == k).encode()).hexdigest() for k in (False, True)}


def test_the_registered_query_on_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op12_prefix_trie(spark, sf).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rebuilt(ordered(rows)))
