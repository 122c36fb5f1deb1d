"""Quality classifier: a modified Kneser-Ney model of character trigrams for each language.

Homes (see travel) count the trigrams of their trusted documents and name all trigrams that their documents hold.
The counts are joined and interpolated as sharded tables: one row per language and trigram, whatever the number of
documents. Every home gets its trigrams' probabilities back and scores its documents. A document is rejected if its
perplexity exceeds a fence made of quantiles of its language, taken over trusted documents that were not counted.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from thermalis.llm.common import bounded_batches, handed_back_by_group, settle, text_bytes, without
from thermalis.llm.travel import home_of, number_of_homes, rows_at_home, sent_home

ORDER = 3
#: Bits of a character in a packed n-gram.
BITS = 21
START, END = 2, 3
#: Bits of a home's number.
HOME = 24
#: One of so many distinct texts of trusted documents sets the fences and is not counted.
HELD_OUT = 5
#: The fence lies so many times the distance from the median to this quantile above the median.
QUANTILE, REACH = 0.95, 3.0
#: All languages' distance counts as so many texts of every language, and no distance is below this many bits.
SHARED, LEAST_DISTANCE = 20, 0.02
#: Trigrams that are counted at once.
SLICE = 1 << 18
#: Characters of median text that are added to every document, so that few characters weigh little.
PRIOR_CHARS = 60


def trigrams(text: str) -> Iterator[np.ndarray]:
    """Packed trigrams of a text with two start marks and an end mark, SLICE at a time."""
    for start in range(0, len(text) + 1, SLICE):
        piece = text[max(start - 2, 0):start + SLICE]
        marks = ([START] * (2 - start) if start < 2 else []), ([END] if start + SLICE > len(text) else [])
        codes = np.concatenate((np.array(marks[0], np.int64), np.frombuffer(piece.encode("utf-32-le"), "<u4").astype(np.int64),
                                np.array(marks[1], np.int64)))
        yield codes[:-2] << 2 * BITS | codes[1:-1] << BITS | codes[2:]


class Counts:
    """Counts of trigrams; memory for the different ones and two slices."""

    def __init__(self):
        self.grams, self.n, self.held, self.waiting = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

    def add(self, grams: np.ndarray, weight: int) -> None:
        self.held.append((grams, weight))
        self.waiting += len(grams)
        if self.waiting >= SLICE:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([self.grams, *[g for g, _ in self.held]])
        weights = np.concatenate([self.n, *[np.full(len(g), w, np.int64) for g, w in self.held]])
        self.grams, where = np.unique(grams, return_inverse=True)
        self.n = np.bincount(where, weights, len(self.grams)).astype(np.int64)
        self.held, self.waiting = [], 0
        return self.grams, self.n


def text_hash(text: bytes) -> int:
    """Signed 64-bit hash of a text; texts of one hash count as copies."""
    return xxh3_64_intdigest(text) - (1 << 63)


def is_held_out(text_hash: int) -> bool:
    return text_hash % HELD_OUT == 0


def home_counts(packs: DataFrame, trusted: DataFrame) -> DataFrame:
    """lang, gram, counted: every trigram of a home; counted is its count in counted documents, which may be 0, times
    2**HOME plus the home."""
    def run(texts, trusted):
        known = set(trusted.column("id").to_pylist())
        by_lang: dict[str, Counts] = {}
        for key, lang, text in rows_at_home(texts):
            if text:
                weight = int(key in known and not is_held_out(text_hash(text)))
                counts = by_lang.setdefault(lang, Counts())
                for grams in trigrams(text.decode("utf-8", "replace")):
                    counts.add(grams, weight)
        home = texts.column("home")[0].as_py() if len(texts) else None
        parts = []
        for lang, counts in by_lang.items():
            grams, n = counts.merge()
            parts.append(pa.table({"lang": pa.array([lang] * len(grams), pa.string()), "gram": pa.array(grams),
                                   "counted": pa.array((n << HOME) + home)}))
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("counted", pa.int64())])
        return pa.concat_tables(parts) if parts else schema.empty_table()

    return (packs.groupBy("home").cogroup(trusted.groupBy("home"))
            .applyInArrow(handed_back_by_group(run), "lang string, gram long, counted long"))


def discount(count: Column) -> Column:
    """Modified Kneser-Ney discount of a count from d1, d2, d3."""
    return F.when(count <= 0, 0.0).when(count == 1, F.col("d1")).when(count == 2, F.col("d2")).otherwise(F.col("d3"))


def discounts(grams: DataFrame) -> DataFrame:
    """lang, d1, d2, d3 from the counts of counts; halves of the counts where too few are there."""
    counts = grams.groupBy("lang").agg(*[F.sum(F.when(F.col("c") == k, 1.0).otherwise(0.0)).alias(f"t{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide(F.col("t1"), F.col("t1") + 2 * F.col("t2"))

    def d(k):
        raw = k - (k + 1) * y * F.try_divide(F.col(f"t{k + 1}"), F.col(f"t{k}"))
        return F.when((raw > 0) & (raw < k), raw).otherwise(k / 2).alias(f"d{k}")

    return counts.select(F.col("lang").alias("d_lang"), d(1), d(2), d(3))


def interpolated(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, p for every row of lang, gram, c; c may be 0.

    An n-gram of the highest order has its count; one of a lower order the number of different characters before it.
    """
    if order == 0:
        return None
    lower_mask = (1 << BITS * (order - 1)) - 1
    suffix = F.col("gram").bitwiseAND(F.lit(lower_mask))
    seen = F.col("c") > 0
    contexts = (grams.where(seen).groupBy(F.col("lang").alias("x_lang"), F.shiftright("gram", BITS).alias("x_context"))
                .agg(F.sum("c").cast("double").alias("total"), *[
                    F.sum(F.when(cond, 1.0).otherwise(0.0)).alias(f"n{k}")
                    for k, cond in ((1, F.col("c") == 1), (2, F.col("c") == 2), (3, F.col("c") > 2))]))
    rows = (grams.withColumns({"context": F.shiftright("gram", BITS), "suffix": suffix})
            .join(contexts, (F.col("lang") == F.col("x_lang")) & (F.col("context") == F.col("x_context")), "left")
            .join(discounts(grams.where(seen)), F.col("lang") == F.col("d_lang"), "left"))
    own = F.coalesce((F.col("c") - discount(F.col("c"))) / F.col("total"), F.lit(0.0))
    back = F.coalesce((F.col("d1") * F.col("n1") + F.col("d2") * F.col("n2") + F.col("d3") * F.col("n3")) / F.col("total"), F.lit(1.0))
    if order == 1:
        kinds = grams.groupBy(F.col("lang").alias("v_lang")).agg((F.count(F.lit(1)) + 1).cast("double").alias("kinds"))
        return (rows.join(kinds, F.col("lang") == F.col("v_lang"))
                .select("lang", "gram", (own + back / F.col("kinds")).alias("p")))
    lower = grams.groupBy("lang", suffix.alias("gram")).agg(F.sum(seen.cast("long")).alias("c"))
    below = interpolated(lower, order - 1).select(F.col("lang").alias("b_lang"), F.col("gram").alias("b_gram"), F.col("p").alias("b_p"))
    return (rows.join(below, (F.col("lang") == F.col("b_lang")) & (F.col("suffix") == F.col("b_gram")))
            .select("lang", "gram", (own + back * F.col("b_p")).alias("p")))


def scored(packs: DataFrame, answers: DataFrame) -> DataFrame:
    """id, lang, n_chars, text_hash, bits (per character; null for empty texts): a row per document."""
    def run(texts, answers):
        tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        langs = np.array(answers.column("lang").to_pylist(), object)
        grams, bits = answers.column("gram").to_numpy(), answers.column("bits").to_numpy()
        for lang in set(langs.tolist()):
            own = langs == lang
            order = np.argsort(grams[own])
            tables[lang] = grams[own][order], bits[own][order]
        out = {"id": [], "lang": [], "n_chars": [], "text_hash": [], "bits": []}
        for key, lang, text in rows_at_home(texts):
            mean, n = None, 0
            if text:
                known, values = tables[lang]
                decoded = text.decode("utf-8", "replace")
                total = sum(float(values[np.searchsorted(known, wanted)].sum()) for wanted in trigrams(decoded))
                mean, n = total / (len(decoded) + 1), len(decoded)
            for name, value in zip(out, (key, lang, n, text_hash(text), mean)):
                out[name].append(value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
        return pa.table({name: pa.array(values, kind) for (name, values), kind in zip(out.items(), kinds)})

    return (packs.groupBy("home").cogroup(answers.groupBy("home"))
            .applyInArrow(handed_back_by_group(run), "id long, lang string, n_chars long, text_hash long, bits double"))


def perplexities(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 lang_column: str = "lang") -> DataFrame:
    """id, lang, n_chars, text_hash, bits, perplexity, trusted, held_out: a row per input row.

    trusted holds the ids of trusted documents, in a column named like id_column. bits is the mean of -log2 of the
    characters' probabilities, null for null or empty texts. Of equal texts all are held out or none. A null language is a language of its own, "". Languages
    without counted text give every character the same probability.
    """
    bounded_batches(docs.sparkSession)
    content, key = text_bytes(text_column), F.col(id_column).cast("long")
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(""))
    n = number_of_homes(docs, content)
    packs = sent_home(docs.select(home_of(key, content, n).alias("home"), key.alias("id"), lang.alias("lang"), content.alias("content")))
    known = trusted.select(key.alias("id")).where("id IS NOT NULL").distinct()
    at_homes = known.select(home_of(F.col("id"), None, n).alias("home"), "id")
    # Both are read many times below, so they are tables: Spark would count anew for every reader.
    at_shards = settle(home_counts(packs, at_homes), "quality-counts")
    kinds = settle(at_shards.groupBy("lang", "gram").agg(F.sum(F.shiftright("counted", HOME)).alias("c")), "quality-kinds")
    model = settle(interpolated(kinds), "quality-model")
    home = F.col("counted").bitwiseAND(F.lit((1 << HOME) - 1)).cast("int").alias("home")
    answers = (at_shards.join(model, ["lang", "gram"])
               .select(home, "lang", "gram", (-F.log2("p")).alias("bits")))
    found = scored(packs, answers)
    marks, is_trusted = known.select(F.col("id").alias("k_id")), F.col("k_id").isNotNull()
    held_out = is_trusted & (F.pmod("text_hash", F.lit(HELD_OUT)) == 0)
    return (found.join(marks, F.col("id") == F.col("k_id"), "left")
            .select(F.col("id").alias(id_column), "lang", "n_chars", "text_hash", "bits",
                    F.pow(F.lit(2.0), F.col("bits")).alias("perplexity"), is_trusted.alias("trusted"), held_out.alias("held_out")))


def fences(scores: DataFrame, quantile: float = QUANTILE, reach: float = REACH) -> DataFrame:
    """f_lang, median, fence: the limits of bits, from trusted documents that were held out; of copies one counts.

    The distance of a language is mixed with that of all languages' texts from their medians, which weighs as much as
    SHARED texts: it is the whole distance where one text was held out, and little where many were.
    """
    texts = (scores.where("held_out AND bits IS NOT NULL").groupBy(F.col("lang").alias("f_lang"), "text_hash")
             .agg(F.min("bits").alias("bits")))
    own = texts.groupBy("f_lang").agg(F.percentile_approx("bits", [0.5, quantile], 10000).alias("q"), F.count("bits").alias("n"))
    own = settle(own.select("f_lang", "n", F.col("q")[0].alias("median"), (F.col("q")[1] - F.col("q")[0]).alias("distance")),
                 "quality-distances")
    every = (texts.join(own.select(F.col("f_lang").alias("m_lang"), "median"), F.col("f_lang") == F.col("m_lang"))
             .agg(F.percentile_approx(F.col("bits") - F.col("median"), quantile, 10000)).first()[0])
    mixed = (F.col("n") * F.col("distance") + F.lit(SHARED * (every or 0.0))) / (F.col("n") + SHARED)
    return own.select("f_lang", "median", (F.col("median") + reach * F.greatest(mixed, F.lit(LEAST_DISTANCE))).alias("fence"))


def classify(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             lang_column: str = "lang", quantile: float = QUANTILE, reach: float = REACH) -> DataFrame:
    """id, lang, n_chars, perplexity, fence (as perplexity), good: a row per input row.

    A document is good unless its bits per character, with PRIOR_CHARS characters of the median added, exceed the
    fence of its language. Null and empty texts, and languages without held-out trusted text, are good: nothing
    speaks against them. Other columns are left out.
    """
    scores = settle(perplexities(docs, trusted, id_column, text_column, lang_column), "quality-scores")
    limits = settle(fences(scores, quantile, reach), "quality-fences")
    eased = (F.col("n_chars") * F.col("bits") + PRIOR_CHARS * F.col("median")) / (F.col("n_chars") + PRIOR_CHARS)
    return (scores.join(limits, F.col("lang") == F.col("f_lang"), "left")
            .select(id_column, "lang", "n_chars", "perplexity", F.pow(F.lit(2.0), F.col("fence")).alias("fence"),
                    F.coalesce(eased <= F.col("fence"), F.lit(True)).alias("good")))


def good_documents(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The rows of docs that are not rejected, with all their columns; rows without an id stay."""
    rejected = classify(docs, trusted, id_column).where("NOT good").select(id_column).distinct()
    return without(docs, rejected, id_column, "quality-rejected")
