"""Substring deduplication by super-k-mers.

A window is WINDOW consecutive words. Its minimiser is the least hash of the SEED-word sequences in it; consecutive
windows with one minimiser form a super-k-mer, which travels as one packed string to the bucket of its minimiser.
There its windows are sorted and each window's smallest document is found, which goes back to the super-k-mer's
home, a chunk of documents.

Only minimisers that occur in two documents or more travel; the others' windows cannot repeat. A minimiser with
many documents sends its windows one by one, by their own hash, so that no bucket has to hold them together. A home
sends a string once, however many of its documents have it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from thermalis.llm.common import bounded_batches, mix, text_bytes, word_hashes
from thermalis.llm.travel import home_of, number_of_homes, rows_at_home, sent_home

WINDOW = 13
SEED = 5
#: A minimiser of more documents is hot.
HOT = 2000
#: Windows of a super-k-mer at most. Only a minimiser that repeats has longer runs; their pieces are often equal, and travel once.
RUN = 64
STEP = np.uint64(0x9E3779B97F4A7C15)


def super_kmers(words: list[bytes], window: int, seed: int) -> tuple[np.ndarray, list[int], list[int]]:
    """Minimiser, first window and end of each super-k-mer of a text; none for fewer words than a window has."""
    n = len(words) - window + 1
    if n < 1:
        return np.empty(0, np.int64), [], []
    hashes = word_hashes(words)
    places = len(words) - seed + 1
    seeds = hashes[:places].copy()
    for i in range(1, seed):
        seeds = seeds * STEP + hashes[i:i + places]
    seeds = mix(seeds)
    least = seeds[:n]
    for i in range(1, window - seed + 1):
        least = np.minimum(least, seeds[i:i + n])
    starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    lengths = np.diff(starts, append=n)
    if lengths.max() > RUN:
        pieces = -(-lengths // RUN)
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = np.repeat(starts, pieces) + piece * RUN
    return least[starts].view(np.int64), starts.tolist(), [*starts[1:].tolist(), n]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shared_minimisers(docs: DataFrame, window: int, seed: int, hot: int) -> DataFrame:
    """home, mini, hot: the minimisers of each home that occur in at least two documents."""
    def run(batches):
        for batch in batches:
            homes, found = [], []
            for key, home, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key is not None:
                    homes.append(home)
                    found.append(np.unique(super_kmers(text.split(), window, seed)[0]))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(homes, pa.int32()),
                                              pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                             names=["home", "minis"])

    # A row for each document and minimiser in it, so that rows count documents.
    each = (docs.select("doc", "home", "content").mapInArrow(run, "home int, minis array<long>")
            .select("home", F.explode("minis").alias("mini")))
    several = (each.groupBy("mini").agg(F.count(F.lit(1)).alias("n"))
               .where("n > 1").select("mini", (F.col("n") > hot).alias("hot")))
    return each.select("home", "mini").join(several, "mini").groupBy("home", "mini").agg(F.max("hot").alias("hot"))


def travelling(docs: DataFrame, shared: DataFrame, window: int, seed: int) -> DataFrame:
    """home, mini, bucket, words, least, most: each home's super-k-mers with the smallest and largest document that has them."""
    def run(texts, minis):
        hot = dict(zip(minis.column("mini").to_pylist(), minis.column("hot").to_pylist()))
        strings: dict[tuple[int, int, bytes], list[int]] = {}
        for key, text in rows_at_home(texts):
            if key is None:
                continue
            words = text.split()
            minis_of, starts, ends = super_kmers(words, window, seed)
            for mini, start, end in zip(minis_of.tolist(), starts, ends):
                if mini not in hot:
                    continue
                cut = [(i, i + 1) for i in range(start, end)] if hot[mini] else [(start, end)]
                for a, b in cut:
                    packed = b" ".join(words[a:b + window - 1])
                    at = (mini, signed(xxh3_64_intdigest(packed)) if hot[mini] else mini, packed)
                    both = strings.get(at)
                    if both is None:
                        strings[at] = [key, key]
                    else:
                        both[0], both[1] = min(both[0], key), max(both[1], key)
        home = texts.column("home")[0].as_py() if len(texts) else None
        return pa.table({"home": pa.array([home] * len(strings), pa.int32()),
                         "mini": pa.array([k[0] for k in strings], pa.int64()),
                         "bucket": pa.array([k[1] for k in strings], pa.int64()),
                         "words": pa.array([k[2] for k in strings], pa.binary()),
                         "least": pa.array([v[0] for v in strings.values()], pa.int64()),
                         "most": pa.array([v[1] for v in strings.values()], pa.int64())})

    return (docs.groupBy("home").cogroup(shared.groupBy("home"))
            .applyInArrow(run, "home int, mini long, bucket long, words binary, least long, most long"))


def counted(strings: DataFrame, window: int) -> DataFrame:
    """home, mini, key, firsts: for each string with a window from a smaller document, every window's smallest document.

    key is the string's 128-bit hash, enough to tell the strings of one home and minimiser apart.
    """
    def windows(packed):
        words = packed.split(b" ")
        return [b" ".join(words[i:i + window]) for i in range(len(words) - window + 1)]

    def judged(rows):
        if len(rows) == 1 and rows[0][3] == rows[0][4]:
            return
        cut = [windows(r[2]) for r in rows]
        first: dict[bytes, int] = {}
        for w, doc in sorted((w, r[3]) for r, parts in zip(rows, cut) for w in parts):
            first.setdefault(w, doc)
        for (home, mini, words, _, most), parts in zip(rows, cut):
            firsts = [first[w] for w in parts]
            if min(firsts) < most:
                yield home, mini, xxh3_128_digest(words), firsts

    def run(batches):
        bucket, held = None, []

        def packed(rows):
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                              names=["home", "mini", "key", "firsts"])

        for batch in batches:
            found = []
            for home, mini, key, words, least, most in zip(*(c.to_pylist() for c in batch.columns)):
                if key != bucket:
                    found.extend(judged(held))
                    bucket, held = key, []
                held.append((home, mini, words, least, most))
            yield packed(found)
        yield packed(list(judged(held)))

    return (strings.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "home int, mini long, key binary, firsts array<long>"))


def cleaned(docs: DataFrame, marks: DataFrame, window: int, seed: int) -> DataFrame:
    """doc, n_words, n_removed, kept (the words that stay, joined by spaces)."""
    def run(texts, marks):
        first = dict(zip(marks.column("key").to_pylist(), marks.column("firsts").to_pylist()))
        marked = set(marks.column("mini").to_pylist())
        keys, n_words, n_removed, kept = [], [], [], []
        for key, text in rows_at_home(texts):
            words = text.split()
            keys.append(key)
            gone = np.zeros(len(words) + 1, np.int64)
            if key is not None and first:
                minis, starts, ends = super_kmers(words, window, seed)
                for mini, start, end in zip(minis.tolist(), starts, ends):
                    if mini not in marked:
                        continue
                    docs_of = first.get(xxh3_128_digest(b" ".join(words[start:end + window - 1])))
                    if docs_of is None:  # a hot minimiser's windows travel alone
                        docs_of = [first.get(xxh3_128_digest(b" ".join(words[i:i + window])), (key,))[0]
                                   for i in range(start, end)]
                    for i, doc in enumerate(docs_of, start):
                        if doc < key:
                            gone[i] += 1
                            gone[min(i + window, len(words))] -= 1
            stays = np.cumsum(gone[:-1]) == 0
            n_words.append(len(words))
            n_removed.append(int(len(words) - stays.sum()))
            kept.append(b" ".join([w for w, s in zip(words, stays.tolist()) if s]))
        return pa.table({"doc": pa.array(keys, pa.int64()), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return (docs.groupBy("home").cogroup(marks.groupBy("home"))
            .applyInArrow(run, "doc long, n_words long, n_removed long, kept binary"))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW,
                   seed: int = SEED, hot: int = HOT) -> DataFrame:
    """id, n_words, n_removed, kept: a row per input row.

    Words are what ASCII white space parts, unchanged. A word goes if a window of words that covers it also starts in
    a document with a smaller id, judged on the input. kept has the words that stay, joined by one space, in UTF-8.
    Null texts have no words. Rows without an id are left whole and make no other row lose words. Rows with the same
    id are one document: they take nothing from each other. Other columns are left out.
    """
    bounded_batches(docs.sparkSession)
    content, key = text_bytes(text_column), F.col(id_column).cast("long")
    home = home_of(key, content, number_of_homes(docs, content))
    rows = docs.select(home.alias("home"), key.alias("doc"), content.alias("content"))
    packed = sent_home(rows)
    strings = travelling(packed, shared_minimisers(rows, window, seed, hot), window, seed)
    found = cleaned(packed, counted(strings, window), window, seed)
    return found.withColumnRenamed("doc", id_column)
