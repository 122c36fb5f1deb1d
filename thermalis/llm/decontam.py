"""Benchmark decontamination by templates.

Numbers, units and names become typed placeholders, whatever stands beside them. Windows of template tokens are hashed
and joined with those of the benchmark. Along one alignment each value of the item's placeholders should map to one value
of the document; of the windows that hold a value with several, only those that are the item's own count. So an item is found
verbatim and with other numbers or names in it. A capitalised word that begins a sentence of an item is a name or a plain
word: an item's windows are there in both readings. Windows of hardly more than placeholders, which would fit any list of
numbers, are hashed and joined by their own words instead: they are found verbatim only.

The benchmark's window hashes thin out the documents' windows through a bit map of fixed size before the join; false
hits of the bit map fall out in the join, which compares the templates themselves.
"""

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from thermalis.llm.common import bounded_batches, handed_back, mix, settle, without

WINDOW = 8
#: Windows with fewer tokens that are no placeholders are compared word by word.
LITERALS = 4
#: What tells hashes and templates of these windows from others.
VERBATIM, VERBATIM_MARK = np.uint64(0xD6E8FEB86659FD93), "= "
#: Least share of an item's windows that a document holds along consistent alignments.
SHARE = 0.5
#: The same where an item's value has several values along an alignment.
CONFLICT_SHARE = 0.75
#: So many windows in a row are enough whatever the item's length, 13 tokens; twice as many where a value has several.
RUN = 6
#: log2 of the bit map's size.
MAP_BITS = 22
#: Distinct words that a worker keeps.
CACHED = 150_000
STEP = np.uint64(0x9E3779B97F4A7C15)

NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/%]*\Z")
MEASURE = re.compile(r"([+-]?[$€£]?\d[\d.,]*)([a-zµ°%²³]+)\Z")
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                         "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
                         "thousand million billion half twice".split())
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces "
                  "pound pounds ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes "
                  "h hour hours day days week weeks month months year years mph kmh dollar dollars cent cents euro euros "
                  "percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres".split())
EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "$+-%") + "“”‘’«»…–—¿¡"


def canonical(word: str) -> str:
    """Template token of a word: <num>, <measure>, <unit>, <name>, or the word in lower case; empty if only marks."""
    core = word.strip(EDGES)
    small = core.lower()
    if NUMBER.match(core) or small in NUMBER_WORDS:
        return "<num>"
    found = MEASURE.match(small)
    if found and found[2] in UNITS | {"%", "°"}:
        return "<measure>"
    if small in UNITS:
        return "<unit>"
    if len(core) > 1 and core[0].isupper() and core[1:].islower():
        return "<name>"
    return small


def ends_sentence(word: str) -> bool:
    return word.rstrip("\"')]”’»")[-1:] in (".", "!", "?", ":")


class Templates:
    """Template tokens of texts, with hashes; words are looked at once while they stay in the cache."""

    def __init__(self, cached: int = CACHED):
        self.cached = cached
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.table = [np.zeros(1024, kind) for kind in (np.uint64, np.uint64, bool, bool)]

    def look(self, words: list[str]) -> np.ndarray:
        """Places of words in the table of facts."""
        if len(self.place) > self.cached:
            self.clear()
        for word in set(words).difference(self.place):
            at = self.place[word] = len(self.place)
            if at == len(self.table[0]):
                self.table = [np.concatenate((column, np.zeros_like(column))) for column in self.table]
            token = canonical(word)
            for column, fact in zip(self.table, (xxh3_64_intdigest(token), xxh3_64_intdigest(own_word(word)), token[:1] != "<", bool(token))):
                column[at] = fact
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def tokens(self, text: str):
        """Words that are tokens, the hashes of their tokens and of themselves, and whether they are literals."""
        words = text.split()
        if not words:
            return [], np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool)
        at = self.look(words)
        hashes, own, literal, token = self.table
        keep = token[at]
        at = at[keep]
        return [w for w, k in zip(words, keep.tolist()) if k], hashes[at], own[at], literal[at]


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of a length."""
    n = len(hashes) - length + 1
    if n < 1:
        return np.empty(0, np.uint64)
    found = hashes[:n].copy()
    for i in range(1, length):
        found = found * STEP + hashes[i:i + n]
    return mix(found)


def own_word(word: str) -> str:
    return word.strip(EDGES).lower()


def slots_of(words: list[str], tokens) -> list[str]:
    return [own_word(w) for w, t in zip(words, tokens) if t[:1] == "<"]


def verbatim(words: list[str]) -> str:
    """What stands for the template of a window that is compared word by word."""
    return VERBATIM_MARK + " ".join(map(own_word, words))


def window_rows(templates: Templates, key, text: str, lengths, wanted, literals: int = LITERALS):
    """(key, place, hash, template, slots) of those windows of a text whose hashes pass the filter."""
    words, hashes, own_hashes, literal = templates.tokens(text)
    upto = np.concatenate(([0], np.cumsum(literal)))
    for length in lengths:
        found = window_hashes(hashes, length)
        places = np.flatnonzero(wanted(found))
        for place, value in zip(places.tolist(), found[places].view(np.int64).tolist()):
            own = words[place:place + length]
            tokens = [canonical(w) for w in own]
            yield key, place, value, " ".join(tokens), slots_of(own, tokens)
        few = np.flatnonzero(upto[length:] - upto[:-length] < min(length, literals)) if len(words) >= length else places[:0]
        if len(few):
            found = window_hashes(own_hashes, length)[few] ^ VERBATIM
            some = wanted(found)
            for place, value in zip(few[some].tolist(), found[some].view(np.int64).tolist()):
                own = words[place:place + length]
                yield key, place, value, verbatim(own), slots_of(own, [canonical(w) for w in own])


def item_rows(key, text: str, window: int, literals: int):
    """(key, place, hash, template, slots, length, lacking, starts) of an item's windows in all their readings.

    A window has enough literals if it has them with the words that begin its sentences as plain words. Where these are
    read as names, `lacking` of them must have the item's own value; starts are their places among the slots. A window
    without enough is there once, with its own words.
    """
    words, start, begins = [], [], True
    for word in text.split():
        if canonical(word):
            words.append(word)
            start.append(begins)
        begins = ends_sentence(word)
    length = min(len(words), window)
    needed = min(length, literals)
    for place in range(len(words) - length + 1 if length else 0):
        own, first = words[place:place + length], start[place:place + length]
        kinds = [canonical(w) for w in own]
        readings = [(t, own_word(w)) if s and t == "<name>" else (t,) for w, t, s in zip(own, kinds, first)]
        if sum(t[:1] != "<" or len(r) > 1 for t, r in zip(kinds, readings)) < needed:
            value = (window_hashes(np.array([xxh3_64_intdigest(own_word(w)) for w in own], np.uint64), length) ^ VERBATIM).view(np.int64)[0]
            yield key, place, int(value), verbatim(own), slots_of(own, kinds), length, 0, []
            continue
        for tokens in product(*readings):
            slots = [i for i, t in enumerate(tokens) if t[:1] == "<"]
            starts = [k for k, i in enumerate(slots) if first[i] and tokens[i] == "<name>"]
            lacking = needed - (length - len(slots))
            if lacking <= len(starts):
                value = window_hashes(np.array([xxh3_64_intdigest(t) for t in tokens], np.uint64), length).view(np.int64)[0]
                yield (key, place, int(value), " ".join(tokens), slots_of(own, tokens), length, max(0, lacking), starts)


SCHEMA = "key long, place int, hash long, template string, slots array<string>"
ITEM_SCHEMA = SCHEMA + ", length int, lacking int, starts array<int>"


def batch_of(rows, schema: str = SCHEMA) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string()),
             "array<int>": pa.list_(pa.int32())}
    names, types = zip(*(column.split() for column in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, k in enumerate(types)], names=list(names))


def item_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int, literals: int) -> DataFrame:
    """Windows of the items; an item of fewer tokens is one window. Items without an id or tokens have none."""
    def run(batches):
        for batch in batches:
            rows = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key is not None and text:
                    rows.extend(item_rows(key, text, window, literals))
            yield batch_of(rows, ITEM_SCHEMA)

    return (benchmark.select(F.col(id_column).cast("long").alias("key"), F.col(text_column).cast("string").alias("text"))
            .mapInArrow(handed_back(run), ITEM_SCHEMA))


def bit_map(windows: DataFrame, bits: int) -> bytes:
    """A bit per low end of the windows' hashes: 2**bits bits, whatever the size of the benchmark."""
    places = windows.select((F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("mask"))
    table = np.zeros(max(1, 1 << bits >> 6), np.int64)
    for row in words.toLocalIterator():
        table[row.word] = row.mask
    return table.tobytes()


def matches(docs: DataFrame, windows: DataFrame, id_column: str, text_column: str, bits: int, literals: int = LITERALS) -> DataFrame:
    """Windows of documents joined with those of the items: doc, item, diagonal, place, slot pairs."""
    spark = docs.sparkSession
    lengths = sorted(row.length for row in windows.select("length").distinct().collect())  # at most `window` numbers
    shared = spark.sparkContext.broadcast((bit_map(windows, bits), lengths))

    def run(batches):
        table = np.unpackbits(np.frombuffer(shared.value[0], np.uint8), bitorder="little").astype(bool)
        lengths, low = shared.value[1], np.uint64((1 << bits) - 1)
        templates = Templates()

        def wanted(hashes):
            return table[(hashes & low).astype(np.int64)]

        for batch in batches:
            rows = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key is not None and text:
                    rows.extend(window_rows(templates, key, text, lengths, wanted, literals))
            yield batch_of(rows)

    bounded_batches(spark)
    found = (docs.select(F.col(id_column).cast("long").alias("key"), F.col(text_column).cast("string").alias("text"))
             .mapInArrow(handed_back(run), SCHEMA))
    items = windows.select(F.col("key").alias("item"), F.col("place").alias("item_place"), "hash",
                           F.col("template").alias("item_template"), F.col("slots").alias("item_slots"), "lacking", "starts")
    own = F.size(F.filter("starts", lambda i: F.get("item_slots", i) == F.get("slots", i)))
    return (found.join(items, "hash").where("template = item_template").where(own >= F.col("lacking"))
            .select(F.col("key").alias("doc"), "item", (F.col("place") - F.col("item_place")).alias("diagonal"), "item_place",
                    F.arrays_zip("item_slots", "slots").alias("pairs")))


def own_values(pairs) -> Column:
    """Whether all placeholders have the item's own values."""
    return F.forall(pairs, lambda p: p["item_slots"] == p["slots"])


def has_run(places: str, n: int) -> Column:
    """Whether sorted distinct places have n in a row."""
    ends = F.transform(places, lambda place, i: F.get(places, i + F.lit(n - 1)) == place + F.lit(n - 1))
    return F.exists(ends, lambda e: F.coalesce(e, F.lit(False)))


def contaminations(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, literals: int = LITERALS,
                   share: float = SHARE, conflict_share: float = CONFLICT_SHARE, run: int = RUN,
                   bits: int = MAP_BITS) -> DataFrame:
    """doc, item, covered (share of the item's windows), verbatim: the pairs that hold enough windows.

    Enough are `share` along alignments where each value of the item has one value, or `conflict_share` along all, without
    the windows that hold a value with several values and are not the item's own; or, on one alignment, `run` windows in a
    row, twice as many if it has such values.

    verbatim: all placeholders have the item's own values. Null or empty texts, and rows without an id, match nothing.
    Windows with fewer literal tokens than `literals` match verbatim only.
    """
    windows = settle(item_windows(benchmark, item_id, item_text, window, literals), "benchmark-windows")
    sizes = windows.groupBy(F.col("key").alias("size_item")).agg(F.countDistinct("place").alias("n_windows"))
    found = matches(docs, windows, id_column, text_column, bits, literals)
    aligned = (found.groupBy("doc", "item", "diagonal")
               .agg(F.collect_set(F.struct("item_place", "pairs")).alias("windows"))
               .withColumn("pairs", F.array_distinct(F.flatten("windows.pairs")))
               .withColumn("values", F.array_distinct("pairs.item_slots"))
               .withColumn("conflict", F.size("values") < F.size("pairs")))
    several = F.filter("values", lambda v: F.size(F.filter("pairs", lambda p: p["item_slots"] == v)) > 1)
    kept = F.filter("windows", lambda w: own_values(w["pairs"]) | ~F.arrays_overlap(w["pairs"]["item_slots"], F.col("several")))
    places = F.array_sort(F.array_distinct(F.col("kept.item_place")))
    in_a_row = F.when(F.col("conflict"), has_run("places", 2 * run)).otherwise(has_run("places", run))
    aligned = (aligned.withColumn("several", F.when(F.col("conflict"), several).otherwise(F.array().cast("array<string>")))
               .withColumn("kept", kept).select("doc", "item", "conflict", places.alias("places"), own_values("pairs").alias("same"))
               .withColumn("in_a_row", in_a_row))

    def covering(which):
        return F.size(F.array_distinct(F.flatten(F.collect_list(F.when(which, F.col("places"))))))

    whole = (aligned.where(F.size("places") > 0).groupBy("doc", "item")
             .agg(covering(~F.col("conflict")).alias("free"), covering(F.lit(True)).alias("n"),
                  F.some("in_a_row").alias("in_a_row"), F.every("same").alias("verbatim")))
    enough = (F.col("free") >= share * F.col("n_windows")) | (F.col("n") >= conflict_share * F.col("n_windows"))
    return (whole.join(sizes, F.col("item") == F.col("size_item")).where(enough | F.col("in_a_row"))
            .select("doc", "item", (F.col("n") / F.col("n_windows")).alias("covered"), "verbatim"))


def verdicts(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **how) -> DataFrame:
    """id, contaminated, items (sorted ids of the items found), verbatim (any): a row per input row."""
    pairs = contaminations(docs, benchmark, id_column, **how)
    found = pairs.groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("verbatim").alias("verbatim"))
    return (docs.select(id_column).join(found, F.col(id_column) == F.col("doc"), "left")
            .select(id_column, F.col("doc").isNotNull().alias("contaminated"),
                    F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
                    F.coalesce("verbatim", F.lit(False)).alias("verbatim")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **how) -> DataFrame:
    """The rows of docs without contamination, with all their columns."""
    found = contaminations(docs, benchmark, id_column, **how).select(F.col("doc").alias(id_column)).distinct()
    return without(docs, found, id_column, "contaminated")
