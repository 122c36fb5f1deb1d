"""Benchmark decontamination on planted leaks."""

from thermalis.llm import decontam

FILLER = "Some plain sentence about rivers and mountains goes on here without any number. " * 5
ITEM = "If Anna buys 12 apples and 7 pears at the market, then how many fruits does Anna carry home in total?"
SAME_SLOTS = ITEM.replace("Anna", "Robert").replace("12", "31").replace("7 pears", "90 pears")
BROKEN = ITEM.replace("Anna carry", "Peter carry")
SHORT = "Define photosynthesis briefly."


def test_planted_leaks(spark):
    items = spark.createDataFrame([(1, ITEM, 5), (2, "An unrelated question about the boiling point of water at sea level, please answer.", 5),
                                   (3, None, 5), (4, "", 5), (5, SHORT, 5), (None, ITEM, 5)], "item_id long, text string, doc int")
    rows = [(10, FILLER + ITEM + FILLER), (11, FILLER + SAME_SLOTS + " " + FILLER), (12, FILLER), (13, None), (14, ""),
            (15, FILLER + BROKEN), (16, ITEM), (17, "Please " + SHORT.lower()), (None, ITEM), (10, FILLER + ITEM + FILLER),
            (18, FILLER * 3000 + ITEM), (19, " ".join(ITEM.split()[:9]) + " " + FILLER)]
    docs = spark.createDataFrame([(a, b, "x", 1.0) for a, b in rows], "doc_id long, text string, items string, place double")
    found = {(r.doc_id, r.contaminated, tuple(r.items), r.verbatim) for r in decontam.verdicts(docs, items).collect()}
    assert {(10, True, (1,), True), (11, True, (1,), False), (12, False, (), False), (13, False, (), False),
            (14, False, (), False), (16, True, (1,), True), (17, True, (5,), True), (None, False, (), False),
            (18, True, (1,), True), (19, False, (), False)} <= found
    assert (15, False, (), False) in found
    kept = decontam.clean_documents(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [12, 13, 14, 15, 19]
    assert decontam.verdicts(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontam.verdicts(docs.limit(0), items).count() == 0


def test_a_full_bit_map_finds_the_same(spark):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = spark.createDataFrame([(i, FILLER + (ITEM if i % 3 else "")) for i in range(9)], "doc_id long, text string")
    assert ({tuple(r) for r in decontam.contaminations(docs, items, bits=6).collect()}
            == {tuple(r) for r in decontam.contaminations(docs, items).collect()}
            == {(i, 1, 1.0, True) for i in range(9) if i % 3})


TOM = "Tom has 5 apples. Tom buys 3 more apples. How many apples does Tom have now?"


def pairs_found(spark, items, texts):
    """(document, item) pairs reported among numbered texts."""
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc, r.item) for r in decontam.contaminations(docs, items).collect()}


def test_words_that_begin_sentences(spark):
    texts = [TOM.replace("Tom", "Sara"), "as follows: " + FILLER + TOM, "Question 17\nDefine photosynthesis briefly.",
             "(a) Define photosynthesis briefly.", "so define photosynthesis briefly", "Explain photosynthesis briefly.",
             "and " + TOM[0].lower() + TOM[1:], FILLER]
    assert pairs_found(spark, [TOM, SHORT], texts) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 1), (6, 0)}


def long_item(n=59):
    """A text of n words, no two windows of which are equal, with the number 5 twice and 3 once."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)]
    words[9], words[45], words[30] = "5", "5", "3"
    return " ".join(words)


def test_one_conflict_costs_its_windows_only(spark):
    item = long_item()
    first, second = item.replace("5", "8", 1), "8".join(item.rsplit("5", 1))
    merged = item.replace("5", "4").replace("3", "4")
    assert pairs_found(spark, [item], [first, second, merged, FILLER + BROKEN, FILLER]) == {(0, 0), (1, 0), (2, 0)}


def test_passages_of_long_items(spark):
    items = [long_item(), " ".join(f"x{w}" for w in long_item(310).split())]
    parts = [items[0].split()[10:42], items[1].split()[100:250], items[0].split()[:13], items[0].split()[:12], items[1].split()[80:93]]
    assert pairs_found(spark, items, [FILLER + " ".join(p) for p in parts]) == {(0, 0), (1, 1), (2, 0), (4, 1)}


def test_items_of_hardly_more_than_values_are_found_verbatim(spark):
    sums = "Compute 12 + 30 * 4 - 7 / 2 = 128 then 45 66 81 90 17 23 54 68 and 9 11 13"
    cities = "Paris London Berlin Madrid Vienna Prague Lisbon Dublin Athens Warsaw Oslo"
    other = sums.replace("30", "31").replace("66", "67").replace("23", "24").replace("9 11", "9 12").replace("128", "129")
    texts = [FILLER + sums + " " + FILLER, cities.replace(" ", ", ") + ".", FILLER + other, " ".join(reversed(cities.split())), "12 30 4 7 2 " * 50, FILLER]
    assert pairs_found(spark, [sums, cities], texts) == {(0, 0), (1, 1)}


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, FILLER + ITEM, 1, 2, 3), (2, FILLER, 1, 2, 3)], "doc_id long, text string, found_id int, doc int, item int")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontam.clean_documents(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]
