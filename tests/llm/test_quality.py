"""The quality classifier on labelled rows and on languages with few or equal texts."""

import math
import random
from collections import Counter

from thermalis.llm import quality, registry
from thermalis.llm.common import documents

LABELLED = "/root/testdata/sf0.1"


def test_shipped_reach_on_labelled_rows(spark):
    found = quality.classify(documents(spark, LABELLED), registry.trusted(spark, LABELLED))
    rows = found.join(registry.table(spark, LABELLED, "labels"), "doc_id").select("quality", "good").collect()
    kept, rejected = [r.good for r in rows if r.quality == 1], [not r.good for r in rows if r.quality == 0]
    assert sum(kept) >= 0.97 * len(kept) and sum(rejected) >= 0.82 * len(rejected)


def text(rng, n=60):
    return " ".join("".join(rng.choices(["ra", "mo", "ti", "lu", "ke", "so", "na", "vi"], k=rng.randint(1, 4))) for _ in range(n))


def test_few_or_equal_held_out_texts(spark):
    rng = random.Random(3)
    rows = [(i, text(rng), "en") for i in range(300)]
    rows += [(1000 + i, text(rng), "rare" if i % 2 else None) for i in range(80)]
    copied = text(rng)
    while not quality.is_held_out(quality.text_hash(copied.encode())):
        copied = text(rng)
    rows += [(2000 + i, copied, "copies") for i in range(200)] + [(3000 + i, text(rng), "copies") for i in range(60)]
    rows += [(4000, "", "en"), (4001, None, None), (None, text(rng), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = {lang: next(i for i, t, own in rows if own == lang and i >= 1000 and quality.is_held_out(quality.text_hash(t.encode())))
            for lang in ("rare", None)}
    counted = [i for i, t, lang in rows if i and 1000 <= i < 1080 and not quality.is_held_out(quality.text_hash(t.encode()))][:12]
    trusted = [*range(300), *held.values(), *counted, *range(2000, 2200), *range(3000, 3060)]
    known = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
    scores = quality.perplexities(docs, known).collect()
    of = {r.doc_id: r for r in scores}
    assert len({r.held_out for r in scores if r.doc_id and 2000 <= r.doc_id < 2200}) == 1 and of[2000].held_out
    assert of[held["rare"]].held_out and not of[4000].held_out and of[4000].bits is None and of[4001].lang == ""
    found = quality.classify(docs, known).collect()
    assert len(found) == len(rows)
    for lang in ("rare", "", "copies", "en"):
        good = [r.good for r in found if r.lang == lang]
        assert sum(good) >= 0.95 * len(good), (lang, sum(good), len(good))
    nothing = quality.classify(docs, known.limit(0)).collect()
    assert len(nothing) == len(rows) and all(r.good for r in nothing)
    assert quality.classify(docs.limit(0), known).count() == 0


def plain_model(texts):
    """The probability of a trigram, from a list of counted texts and all texts of a language, with dictionaries."""
    counted, every = texts

    def grams(t):
        marked = "\2\2" + t + "\3"
        return [marked[i:i + 3] for i in range(len(t) + 1)]

    tables = [Counter(g for t in counted for g in grams(t))]
    for _ in range(2):
        tables.append(Counter(g[1:] for g in tables[-1]))
    kinds = len({g[-1] for t in every for g in grams(t)}) + 1

    def p(gram, level=0):
        if level == 3:
            return 1 / kinds
        table, below = tables[level], p(gram[1:], level + 1)
        t = [sum(c == k for c in table.values()) for k in range(5)]
        y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else None
        d = [0.0]
        for k in (1, 2, 3):
            raw = k - (k + 1) * y * t[k + 1] / t[k] if y is not None and t[k] else -1
            d.append(raw if 0 < raw < k else k / 2)
        followers = [c for g, c in table.items() if g[:-1] == gram[:-1]]
        if not followers:
            return below
        total, c = sum(followers), table[gram]
        return (c - d[min(c, 3)]) / total + sum(d[min(f, 3)] for f in followers) / total * below

    return lambda t: sum(-math.log2(p(g)) for g in grams(t)) / (len(t) + 1)


def test_bits_against_dictionaries(spark):
    rng = random.Random(5)
    rows = [(i, text(rng, 8), lang) for i, lang in enumerate(["en", None, "de"] * 12)] + [(90, "zq", "none"), (91, "", "en"), (92, None, "en")]
    rows += [(93, rows[0][1], "en"), (94, rows[1][1], None)]
    trusted = {*range(24), 91, 93}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = spark.createDataFrame([(i,) for i in sorted(trusted)], "doc_id long")
    models = {}
    for lang in ("en", "", "de", "none"):
        own = [(i, t) for i, t, of in rows if (of or "") == lang and t]
        counted = [t for i, t in own if i in trusted and not quality.is_held_out(quality.text_hash(t.encode()))]
        models[lang] = plain_model((counted, [t for _, t in own]))
    found = {r.doc_id: r for r in quality.perplexities(docs, known).collect()}
    assert len(found) == len(rows)
    for i, t, lang in rows:
        want = models[lang or ""](t) if t else None
        assert found[i].bits is None if want is None else abs(found[i].bits - want) < 1e-9, i


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(i, "ra mo ti lu", "en", 1, 2) for i in range(5)], "doc_id long, text string, lang string, rejected_id int, good int")
    kept = quality.good_documents(docs, docs.select("doc_id"))
    assert kept.columns == docs.columns and kept.count() == 5
