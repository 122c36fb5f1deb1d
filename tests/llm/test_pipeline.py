"""The stages in a row against plain versions, on a small corpus."""

import ctypes
import random
import re
from pathlib import Path

import corpus_pipeline
import pytest
from test_ngram_join import brute

from thermalis.llm import exact_dedup
from thermalis.llm.common import handed_back, handed_back_by_group
from thermalis.llm.travel import sent_home


def corpus():
    rng = random.Random(8)
    syllables = ["ra", "mo", "ti", "lu", "ke", "so", "na", "vi"]

    def words(n):
        return ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]

    texts = {i: " ".join(words(rng.randint(60, 200))) + "." for i in range(200)}
    item = " ".join(words(30)) + "?"
    texts |= {200: texts[5], 201: texts[5], 202: texts[7] + " " + words(1)[0], 203: texts[8] + " " + item + " " + texts[9],
              204: "§$%& ~~ ## §§ ^^ " * 40, 205: "XQ!! ZJ!! QXZ!! WXY!! " * 30, 206: "", 207: None}
    return texts, item


def test_stages(spark, tmp_path):
    texts, item = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left, now = dict(texts), spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        kept = stage(spark, now, str(tmp_path))
        assert kept.columns == docs.columns, name
        kept.write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 0:
            gone = {204, 205}
        elif k == 1:
            gone = {i for i, t in left.items() if any((u or "") == (t or "") and j > i for j, u in left.items())}
            assert gone == {5, 200, 206}
        elif k == 2:
            gone = {d for d, _, c in brute(list(left.items()), 5, 80) if d != c}
            assert 202 in gone
        else:
            gone = {203}
        left = {i: t for i, t in left.items() if i not in gone}
        assert {r.doc_id: r.text for r in now.collect()} == left, name
    tokens = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in tokens} == set(left)


def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]


def test_a_task_of_the_last_stage_has_one_python_worker(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the cat"), (2, None)], "doc_id long, text string")
    found = corpus_pipeline.tokens(spark, docs, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.n_tokens) for r in found.collect()) == [(1, 2), (2, 0)]


def test_workers_give_freed_memory_back():
    libc = ctypes.CDLL(None)
    if not hasattr(libc, "malloc_trim"):
        pytest.skip("not glibc")

    def held():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    def run(batches):
        for batch in batches:
            # The last of many blocks stays, so the allocator keeps the rest of its heap.
            blocks = [bytes(4000) for _ in range(20_000)]
            kept.append(blocks.pop())
            yield batch

    kept, before = [], held()
    assert list(handed_back(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 30
    assert handed_back_by_group(lambda left, right: (left, right))(1, 2) == (1, 2)


def test_python_stages_give_memory_back(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(1, "the cat"), (2, None)], "doc_id long, text string")
    runs, plain = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, *how: runs.append(run) or plain(self, run, *how))
    corpus_pipeline.tokens(spark, docs, str(tmp_path))
    sent_home(docs.selectExpr("1 AS home", "doc_id"))
    assert len(runs) == 3
    assert all(run.__module__.startswith("thermalis.") and hasattr(run, "__wrapped__") for run in runs)


def test_texts_without_copies_do_not_travel(spark):
    rows = [(i, f"text {i}") for i in range(400)] + [(500, "text 7"), (501, "text 7"), (501, "text 7"), (None, ""), (None, None), (502, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = exact_dedup.dedup(docs)
        found = sorted(map(tuple, kept.collect()), key=str)
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == sorted([*((i, f"text {i}") for i in range(400) if i != 7), (501, "text 7"), (502, "")], key=str)
    # Two joins, of the rows that may be copies; the others come by a branch without one.
    assert plan.count("Join LeftOuter") + plan.count("Join Inner") == 2 and plan.lower().count("getbit") >= 3
