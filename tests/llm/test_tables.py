"""WARC, sharding, URL rules and exact dedup against plain versions."""

import base64
import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from thermalis.llm import exact_dedup, sharding, urls, warc


def test_warc_round_trip(spark):
    rows = [(1, "http://a/ b", "x"), (2, None, "x"), (3, "u", None), (4, "u\r\n", ""), (5, "é", "ü\r\n\r\n" * 200_000), (6, "u", "y")]
    pages = spark.createDataFrame([(*r, "n", 1) for r in rows], "page_id long, url string, html string, seq string, n_bytes int")
    got = {tuple(r) for r in warc.round_trip(pages.repartition(3)).collect()}
    want = set()
    for page, _, html in rows:
        same = max(p for p, _, h in rows if (h or "") == (html or ""))
        data = (html or "").encode()
        want.add((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                  "response" if page == same else "revisit", None if page == same else same))
    assert got == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_shards_have_equal_bytes_and_gapless_slots(spark):
    rows = [(i, ("hot " * 50) if i % 3 == 0 else f"text {i} " * (i % 40), None if i % 7 == 0 else "en", f"s{i % 5}", 1) for i in range(3000)]
    rows += [(9000, None, None, None, 1), (None, "no id", "en", "s1", 1)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, slot int"), 8).collect()
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    assert len(found) == len(rows)
    sizes, slots = Counter(), {}
    for r in found:
        assert r["size"] == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        sizes[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) < 1.05 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_url_rules_and_held_out_hosts(spark):
    table = urls.labelled(spark)
    model = urls.train(table)
    rows = [(1, "https://A.example.ORG/es/1?q"), (2, "x://example.org/en/12"), (3, "x://b.org/en/2"), (4, "x://c.com/fr/"),
            (5, "x://com/de/1#t"), (6, None), (7, "no scheme"), (8, "x://myexample.org/es/"), (9, "x://b.org")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), model).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (1, 2, 3, 4, 5, 8)] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("com/fr/", "allow"), ("com/de/", "block"), ("org/", "allow")]
    assert (got[1].host, got[1].path) == ("a.example.org", "/es/1") and (got[9].host, got[9].path, got[9].rule) == ("b.org", "", None)
    assert all((got[i].host, got[i].path, got[i].rule) == ("", "", None) for i in (6, 7))


def test_hosts_that_were_held_out(spark):
    """Each host has one row, and both classes have the same paths: only the host's words tell them apart."""
    table = urls.labelled(spark)
    part = F.pmod(F.xxhash64("url"), F.lit(4)) == 0
    model = urls.train(table.where(~part))
    judged = urls.judge(table.where(part).select("url", "blocked"), model, [("allow", "none", "/")], id_column="blocked")
    right = judged.where((F.col("verdict") == "block") == (F.col("blocked") == 1.0)).count()
    assert judged.count() > 80 and right >= 0.9 * judged.count()
    bare = table.where(part).select("blocked", F.concat(F.regexp_extract("url", r"^(https://[^/]*)", 1), F.lit("/en/1")).alias("url"))
    judged = urls.judge(bare, model, [("allow", "none", "/")], id_column="blocked")
    assert judged.where((F.col("verdict") == "block") == (F.col("blocked") == 1.0)).count() >= 0.9 * judged.count()


def test_urls_with_nulls_repeats_and_clashing_columns(spark):
    model = urls.train(urls.labelled(spark))
    rows = [(1, None, "a", 1), (1, None, "a", 1), (None, "http://x.org/", "b", 2), (3, "", "c", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, url_rule int")
    got = urls.judge(pages, model).collect()
    assert sorted((r.page_id or 0, r.host, r.path, r.rule or "") for r in got) == [(0, "x.org", "/", "org/"), (1, "", "", ""), (1, "", "", ""), (3, "", "", "")]
    assert urls.judge(pages.limit(0), model).collect() == []


@pytest.mark.parametrize("bits", [3, 23])
def test_equal_texts_even_where_digests_collide(spark, monkeypatch, bits):
    monkeypatch.setattr(exact_dedup, "MAP_BITS", bits)
    rows = [(i, f"text {i % 6}") for i in range(40)] + [(50, None), (51, ""), (None, "text 1"), (7, "text 1")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keep_id int")
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = {(i, max(x for x in groups[t or ""] if x is not None), len(groups[t or ""])) for i, t in rows}
    for digest in (exact_dedup.sha256, lambda c: F.unhex(F.hex(F.pmod(F.crc32(c), F.lit(2))))):
        found = exact_dedup.exact_groups(docs, digest=digest).collect()
        assert sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size) for r in found))) == sorted(map(repr, want))
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


def test_copies_share_a_shard(spark):
    rows = [(i, f"text {i} " * 30) for i in range(4000)]
    one = sum(len(t) + 1 for _, t in rows) // 8
    copied = [(10_000 + i, "copied text " * 20) for i in range(one // 20 // 241)] + [(20_000 + i, f"twice {i // 2} " * 100) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in [*rows, *copied, *copied[:1]]], "doc_id long, text string, lang string, source string")
    found = sharding.shard(docs, 8).collect()
    shards, sizes = {}, Counter()
    for r in found:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
        sizes[r.shard] += r["size"]
    assert len(found) == docs.count() and all(len(s) == 1 for s in shards.values())
    assert max(sizes.values()) < 1.05 * min(sizes.values())
    assert sharding.shard(docs.limit(0), 8).collect() == []


def test_columns_that_clash_in_dedup(spark):
    rows = [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (None, "a"), (None, "c")]
    names = "dedup_id dedup_digest dedup_digest_of kept digest found_id id row".split()
    docs = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.row) for r in kept.collect()) == [(0, "c", 7), (2, "a", 7), (3, "b", 7)]


def test_long_texts_in_dedup(spark):
    long = "word " * 600_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, long + "x")], "doc_id long, text string")
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs).collect()) == [(1, 2, 2), (2, 2, 2), (3, 3, 1)]
