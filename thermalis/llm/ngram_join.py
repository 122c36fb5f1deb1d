"""Exact n-gram Jaccard join with set-relation skipping, down to connected components.

Documents with equal shingle sets are one class. A class's shingles have one order everywhere (rare ones by hash, then
the frequent ones by their counts), and only the first of them, enough for the threshold, are indexed. The index's lists are skipped in four ways:

* by equality: shingles that the same documents have are one list;
* by position and size: long lists are cut in blocks of similar set sizes and only blocks that can hold links meet. All
  before the places of the first common shingle is different, which bounds the overlap; rows that no other row of their list
  could bear are left out. Linked sets of similar sizes have many indexed shingles in common: a set with few meets none;
* by leaders: first every set is compared with the one pivot of its lists that shares most indexed shingles with it. Lists
  whose sets these answers already connect need no comparison;
* by differences: the sets of a long list that is left are compared with a reference set that most of them resemble. Let
  D be a set's difference to it. Two sets whose D are small enough link for certain, and then both link with the set that
  is nearest to the reference: that one's answers stand for theirs. Two others link only if their D share shingles, so
  they meet in an index of the first shingles of D, enough for the threshold. Its lists are treated like the index's own,
  and are shorter, as most sets lack most of any set's D. Only short lists are compared pair by pair.

A candidate pair first meets in its parity sketches: every shingle flips one bit, so two sketches differ in no more
bits than the sets differ in shingles. What the sketches cannot refute is compared on the whole sets.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from thermalis.llm.common import bounded_batches, handed_back, mix, release, settle, text_bytes, without, word_hashes

WORDS, PART, WHOLE = 4, 85, 100
#: Shingles of this many documents of one batch are reported, and those of most documents are ordered last. Any choice
#: of them gives the same links.
REPORTED, ORDERED = 4, 100_000
#: log2 of the bit map of classes that have a candidate.
MAP_BITS = 23
#: So often every set is compared with a leader. Lists of at most SHORT sets are compared pair by pair, after the first turn of
#: differences those of LATER, and all that are left after MOST turns. Any numbers give the same components.
TURNS, SHORT, LATER, MOST = 1, 64, 64, 3
STEP = np.uint64(0x9E3779B97F4A7C15)
#: A table is written by a task for so many of its rows, and by as many as there are cores at least.
TASK_ROWS = 50_000
#: So many shingles weigh as much as a row.
HEAVY = 16


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles, A-Z in lower case; of all words if they are fewer."""
    hashes = word_hashes(text.lower().split())
    n = len(hashes) - k + 1
    if n < 1:
        if not len(hashes):
            return hashes
        n, k = 1, len(hashes)
    found = hashes[:n].copy()
    for i in range(1, k):
        found = found * STEP + hashes[i:i + n]
    return np.unique(mix(found + np.uint64(k)))


def sketch(tokens: np.ndarray) -> bytes:
    """A bit per place: whether an odd number of shingles falls there. 2 to 4 places a shingle, a power of two."""
    if not len(tokens):
        return b""
    places = 1 << max(6, (2 * len(tokens) - 1).bit_length())
    counts = np.bincount((tokens & np.uint64(places - 1)).view(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(parities: np.ndarray, size: int) -> np.ndarray:
    """The sketch of the same set with fewer places; both sizes in bytes are powers of two."""
    return np.bitwise_xor.reduce(parities.reshape(-1, size), axis=0)


def least_difference(a: bytes, b: bytes) -> int:
    """In how many shingles the sets of two sketches differ at least; the longer sketch is folded to the shorter one."""
    short, long = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    return int(np.bitwise_count(folded(long, len(short)) ^ short).sum())


def texts_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc"), text_bytes(text_column).alias("content"))


def frequent(rows: DataFrame, k: int) -> list[int]:
    """At most ORDERED shingles that many documents have."""
    def run(batches):
        for batch in batches:
            found = [shingles(t, k) for t in batch.column(0).to_pylist()]
            tokens, counts = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            often = counts >= REPORTED
            yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often], pa.int64())],
                                             names=["token", "n"])

    counted = rows.select("content").mapInArrow(handed_back(run), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return [r.token for r in counted.orderBy(F.desc("n"), "token").limit(ORDERED).collect()]


class Order:
    """The common order of shingles: those that are not frequent by hash, then the frequent ones, the most frequent last."""

    def __init__(self, most_frequent_first: list[int]):
        tokens = np.array(most_frequent_first, np.int64).view(np.uint64)
        place = np.argsort(tokens)
        self.often, self.rank = tokens[place], -place

    def sort(self, tokens: np.ndarray) -> np.ndarray:
        """Sorted shingles in the common order."""
        if not len(self.often) or not len(tokens):
            return tokens
        at = np.minimum(np.searchsorted(self.often, tokens), len(self.often) - 1)
        late = self.often[at] == tokens
        return np.concatenate((tokens[~late], tokens[late][np.argsort(self.rank[at[late]])]))


def prefixes(rows: DataFrame, k: int, part: int, whole: int, last: list[int]) -> DataFrame:
    """doc, n, digest and sketch of the set, and its first shingles in the common order: n - ceil(n * part / whole) + 1."""
    shared = rows.sparkSession.sparkContext.broadcast(Order(last))

    def run(batches):
        order = shared.value
        for batch in batches:
            out = [[], [], [], [], []]
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = shingles(text, k)
                n = len(tokens)
                ordered = order.sort(tokens)
                first = ordered[:n + (-n * part // whole) + 1] if n else ordered
                for column, value in zip(out, (key, n, xxh3_128_digest(tokens.tobytes()), sketch(tokens), first.view(np.int64))):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["doc", "n", "digest", "sketch", "first"])

    return settle(rows.mapInArrow(handed_back(run), "doc long, n long, digest binary, sketch binary, first array<long>"), "shingle-prefixes")


def settled(df: DataFrame, label: str, rows: int) -> DataFrame:
    """df as a table, given how many rows it has at most (or so many as weigh as much).

    Every file of a table costs the time to make it and its rights, and on a local disk a process that the executor forks
    for that, so small tables of many partitions are written by few tasks. That only joins partitions: no row moves.
    """
    return settle(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))), label)


def bit_map(wanted: DataFrame, bits: int) -> Broadcast:
    """The places of the wanted rep, as a bit map of fixed size. Its words, of which there are 2**bits / 64 at most, come to
    the driver in one job, not in one for each partition."""
    low = (1 << bits) - 1
    words = (wanted.select(F.xxhash64("rep").bitwiseAND(F.lit(low)).alias("place"))
             .groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(place & 63 AS INT))")).alias("mask")))
    table = np.zeros(1 << bits >> 6, np.int64)
    found = words.toArrow()
    table[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(table.tobytes())


def place_of(column: str, bits: int) -> Column:
    return F.xxhash64(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("place")


def marked(rows: DataFrame, wanted: DataFrame, bits: int) -> DataFrame:
    """rows and marked: true if doc is wanted, and for some others."""
    shared = bit_map(wanted, bits)

    def run(batches):
        table = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")
        for batch in batches:
            found = pa.array(table[batch.column(batch.num_columns - 1).to_numpy()] == 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*batch.schema.names[:-1], "marked"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.select("*", place_of("doc", bits)).mapInArrow(handed_back(run), f"{kinds}, marked boolean")


def whole_sets(rows: DataFrame, wanted: DataFrame, k: int, bits: int) -> DataFrame:
    """rep, tokens for the wanted documents and some others: the bit map spares most of them."""
    shared = bit_map(wanted, bits)

    def run(batches):
        table = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little")
        for batch in batches:
            keep = [i for i, place in enumerate(batch.column(2).to_pylist()) if table[place]]
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in keep], pa.int64()),
                 pa.array([shingles(texts[i].as_py(), k).view(np.int64) for i in keep], pa.list_(pa.int64()))], names=["rep", "tokens"])

    placed = rows.where("doc IS NOT NULL").select("doc", "content", place_of("doc", bits))
    return settle(placed.mapInArrow(handed_back(run), "rep long, tokens array<long>"), "shingle-sets")


def behind(part: int, whole: int) -> Column:
    """The weight of what two sets have in common from the place of a shingle on, taken off: see can_link."""
    return 2 * (whole + part) * F.col("at") - F.col("weight") - 2 * (whole - part) * F.col("n")


def can_link(part: int, whole: int) -> Column:
    """Whether sizes, places and counts allow that a (n, weight, behind, met) and b link and have this as first common shingle.

    With D as in differences, or the whole set, D differ at least in what stands before the places and in what is longer behind
    them. That is (weight + b_behind) / (whole + part) or the like with a and b exchanged over what links bear. Besides, the first of
    the common shingles are in both indexed parts; met is how many of a set's indexed shingles another set has.
    """
    n, b_n = F.col("n").cast("long"), F.col("b_n").cast("long")
    common = part * whole * (n + b_n) - part * (part + whole) * F.greatest(n, b_n)
    return ((whole * F.least(n, b_n) >= part * F.greatest(n, b_n)) & (F.col("weight") + F.col("b_behind") <= 0)
            & (F.col("b_weight") + F.col("behind") <= 0) & ((part + whole) * whole * F.least("met", "b_met") >= common))


def merged(lists: DataFrame) -> DataFrame:
    """list, leader, rep, n, weight, met, at, m: shingles that the same documents have become one list, for each leader.

    m is the number of its shingles, at the place of the first. Lists are numbered by hashes; two that get one
    number are compared together, which changes no result.
    """
    one, two = F.xxhash64("rep"), F.xxhash64(F.lit(7), "rep")
    members = (lists.groupBy("token").agg(F.bit_xor(one).alias("x"), F.bit_xor(two).alias("y"), F.count(F.lit(1)).alias("c"), F.min("leader").alias("l"))
               .where("c > 1").select("token", F.xxhash64("x", "y", "c", "l").alias("list")))
    return (lists.join(members, "token").groupBy("list", "leader", "rep", "n", "weight", "met")
            .agg(F.min("at").alias("at"), F.sum("m").cast("int").alias("m")))


def with_met(lists: DataFrame) -> DataFrame:
    """met becomes the number of a set's shingles in the lists."""
    met = lists.groupBy("rep").agg(F.sum("m").cast("int").alias("met"))
    return lists.drop("met").join(met, "rep")


#: What two rows of a list need to meet.
MEETING = ["n", "weight", "behind", "met", "component"]
ROW = ["list", "leader", "rep", "n", "weight", "met", "at", "m", "component"]


def mixed_lists(lists: DataFrame, labels: DataFrame | None, label: str, part: int, whole: int, n: int) -> DataFrame:
    """ROW, size: the lists that hold different components, with their number of sets; without labels all that hold two
    sets. Rows that can link with none of their list are left out. n: rows of lists, at most."""
    own = lists.select(*[c for c in ROW if c != "component"])
    rows = own.withColumn("component", F.col("rep"))
    if labels is not None:
        rows = own.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = (rows.groupBy("list").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("weight").alias("least_weight"),
                                        F.min(behind(part, whole)).alias("least_behind")).where("lo < hi"))
    fit = (rows.join(least, "list").where((F.col("weight") + F.col("least_behind") <= 0) & (behind(part, whole) + F.col("least_weight") <= 0))
           .select(*ROW))
    whole_list = Window.partitionBy("list")
    sized = fit.select(*ROW, F.count(F.lit(1)).over(whole_list).cast("int").alias("size"), F.min("component").over(whole_list).alias("lo"),
                       F.max("component").over(whole_list).alias("hi"))
    return settled(sized.where("lo < hi").select(*ROW, "size"), label, n)


def leaders(lists: DataFrame, turn: int, part: int, whole: int, n: int) -> DataFrame:
    """a, b: every one of at most n sets with that pivot of its lists that has most indexed shingles in common with it, others
    each turn."""
    rows = lists.withColumn("behind", behind(part, whole))
    first = F.min(F.struct(F.xxhash64(F.lit(turn), "rep"), "rep", *MEETING)).alias("pivot")
    pivots = rows.groupBy("list").agg(first).select("list", F.col("pivot.rep").alias("b"), *[F.col(f"pivot.{c}").alias(f"b_{c}") for c in MEETING])
    met = rows.join(pivots, "list").where((F.col("component") != F.col("b_component")) & can_link(part, whole))
    common = met.groupBy(F.col("rep").alias("a"), "b").agg(F.sum("m").alias("m"))
    return settled(common.groupBy("a").agg(F.max_by("b", F.struct("m", "b")).alias("b")), "leader-pairs", n)


def short_pairs(lists: DataFrame, part: int, whole: int) -> DataFrame:
    """a, b: the pairs of different components in the same list that sizes and places allow. For short lists."""
    rows = lists.withColumn("behind", behind(part, whole)).select("list", "rep", *MEETING)
    other = rows.select("list", F.col("rep").alias("b"), *[F.col(c).alias(f"b_{c}") for c in MEETING])
    return (rows.join(other, "list")
            .where((F.col("rep") < F.col("b")) & (F.col("component") != F.col("b_component")) & can_link(part, whole))
            .select(F.col("rep").alias("a"), "b").distinct())


def size_blocks(lists: DataFrame, part: int, whole: int) -> DataFrame:
    """The rows of long lists in lists of two neighbouring blocks of sizes each; sets that can link are in one of them.
    Equal lists are merged again."""
    block = F.floor(F.log("n") / math.log(whole / part)) if part < whole else F.col("n").cast("long")
    return merged(lists.withColumn("block", F.explode(F.array(block, block - 1)))
                  .select(F.xxhash64("list", "block").alias("token"), "leader", "rep", "n", "weight", "met", "at", "m"))


def grouped(lists: DataFrame, turn: int, n: int) -> DataFrame:
    """leader, rep, n: the sets of all long lists of the index that have the same pivot; later, of each long list. n: rows of
    lists, at most."""
    if turn:
        return settled(lists.select(F.col("list").alias("leader"), "rep", "n"), "difference-groups", n)
    pivots = lists.groupBy("list").agg(F.min(F.struct(F.xxhash64("rep"), "rep")).alias("pivot"))
    return settled(lists.join(pivots, "list").select(F.col("pivot.rep").alias("leader"), "rep", "n").distinct(), "difference-groups", n)


def references(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """leader, reference: the shingles that two of a group's first three sets have, by hash."""
    place = F.row_number().over(Window.partitionBy("leader").orderBy(F.xxhash64("rep"), "rep"))
    three = groups.withColumn("place", place).where("place <= 3").select("leader", "rep").join(sets, "rep")
    one, two, other = (F.coalesce(F.get("three", F.lit(i)), F.array().cast("array<long>")) for i in range(3))
    most = F.array_union(F.array_union(F.array_intersect(one, two), F.array_intersect(one, other)), F.array_intersect(two, other))
    return three.groupBy("leader").agg(F.collect_list("tokens").alias("three")).select("leader", most.alias("reference"))


def differences(groups: DataFrame, sets: DataFrame, last: list[int], part: int, whole: int) -> DataFrame:
    """leader, rep, n, weight, first: the first shingles of each set's difference D to the reference of its group.

    Two sets of sizes n link if, and without common shingles of D only if, their weights (whole + part) * |D| -
    (whole - part) * n sum up to 0 or less. Else D must share |D| - n * (whole - part) / part shingles or more, and one;
    and half of the sum of weights / (whole + part).
    """
    shared = groups.sparkSession.sparkContext.broadcast(Order(last))

    def run(batches):
        order = shared.value
        for batch in batches:
            leaders, reps, sizes = (batch.column(c) for c in (0, 1, 2))
            weights, firsts = [], []
            for n, tokens, reference in zip(sizes.to_pylist(), batch.column(3), batch.column(4)):
                own = tokens.values.to_numpy().view(np.uint64)
                most = np.sort(reference.values.to_numpy().view(np.uint64)) if reference.is_valid else own[:0]
                d = order.sort(np.setxor1d(own, most, assume_unique=True))
                weights.append((whole + part) * len(d) - (whole - part) * n)
                firsts.append(d[:n * (whole - part) // part + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays([leaders, reps, sizes, pa.array(weights, pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                                             names=["leader", "rep", "n", "weight", "first"])

    rows = groups.join(sets, "rep").join(references(groups, sets), "leader", "left").select("leader", "rep", "n", "tokens", "reference")
    heavy = groups.agg(F.sum("n")).first()[0] // HEAVY
    return settled(rows.mapInArrow(handed_back(run), "leader long, rep long, n int, weight long, first array<long>"), "differences", heavy)


def nearest_links(found: DataFrame) -> DataFrame:
    """a, b: the sets that link for certain with their group's nearest set to the reference."""
    nearest = found.groupBy("leader").agg(F.min(F.struct("weight", "rep")).alias("nearest"))
    met = found.join(nearest, "leader").where((F.col("rep") != F.col("nearest.rep")) & (F.col("weight") + F.col("nearest.weight") <= 0))
    return met.select(F.col("nearest.rep").alias("a"), F.col("rep").alias("b"))


def difference_lists(found: DataFrame, turn: int, part: int, whole: int) -> DataFrame:
    """The index of the differences of all groups, equal lists of a group merged, as a table: columns of merged; met says
    nothing here."""
    least = found.groupBy("leader").agg(F.min("weight").alias("least"))
    # At most |D| less half of the least sum of weights.
    needed = F.floor((F.col("weight") + 2 * (whole - part) * F.col("n") - F.col("least")) / (2 * (whole + part))).cast("int") + 1
    entries = (found.join(least, "leader")
               .select("leader", "rep", "n", "weight", F.posexplode(F.slice("first", F.lit(1), F.greatest(needed, F.lit(0)))).alias("at", "token")))
    common = entries.groupBy("leader", "token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("leader", "token")
    lists = (entries.join(common, ["leader", "token"])
             .select(F.xxhash64(F.lit(turn), "leader", "token").alias("token"), "leader", "rep", "n", "weight", F.col("n").alias("met"), "at",
                     F.lit(1).alias("m")))
    most = found.agg(F.sum(F.size("first"))).first()[0] or 0
    return settled(merged(settled(lists, "difference-index", most)), "difference-lists", most)


def plausible(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """The pairs a, b that their sketches do not refute. sets: doc, n, sketch."""
    def run(batches):
        for batch in batches:
            keep = [whole * (n + b_n - d) >= part * (n + b_n + d)
                    for n, b_n, x, y in zip(*(c.to_pylist() for c in batch.columns[2:])) for d in (least_difference(x, y),)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    sets = marked(sets.select("doc", "n", "sketch"), ends_of(pairs), MAP_BITS).where("marked")
    met = (pairs.join(sets.select(F.col("doc").alias("a"), "n", F.col("sketch").alias("x")), "a")
           .join(sets.select(F.col("doc").alias("b"), F.col("n").alias("b_n"), F.col("sketch").alias("y")), "b"))
    return met.select("a", "b", "n", "b_n", "x", "y").mapInArrow(handed_back(run), "a long, b long").distinct()


def linked(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """The pairs a, b whose sets (rep, tokens) have whole * intersection >= part * union."""
    both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("tokens").alias("a_tokens")), "a")
            .join(sets.select(F.col("rep").alias("b"), F.col("tokens").alias("b_tokens")), "b"))
    common = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (both.withColumn("common", common)
            .where(whole * F.col("common") >= part * (F.size("a_tokens") + F.size("b_tokens") - F.col("common"))).select("a", "b"))


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """rep, component: the smallest rep that is reachable, for all ends of the edges a, b."""
    n = 2 * edges.count()
    both = settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges", n)
    labels = settled(both.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("b"), F.min("a")).alias("component")), "labels", n)
    n = labels.count()
    while True:
        heard = (both.join(labels, F.col("b") == F.col("rep")).groupBy(F.col("a").alias("h_rep"))
                 .agg(F.min("component").alias("heard")))
        lower = (labels.join(heard, F.col("rep") == F.col("h_rep"))
                 .select("rep", F.col("component").alias("old"), F.least("component", "heard").alias("component")))
        # The label's own label is nearer to the least.
        jump = lower.select(F.col("rep").alias("j_rep"), F.col("component").alias("jump"))
        now = settled(lower.join(jump, F.col("component") == F.col("j_rep"), "left")
                      .select("rep", "old", F.least("component", "jump").alias("component")), "labels", n)
        labels = now.select("rep", "component")
        if now.where("old != component").isEmpty():
            return labels


def cluster(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = WORDS, part: int = PART,
            whole: int = WHOLE) -> DataFrame:
    """id, n_shingles, component_id: a row per input row.

    Two documents link when whole * intersection >= part * union of their sets of distinct k-word shingles (A-Z in
    lower case; words are parted by ASCII white space); component_id is the smallest id that links reach. With fewer
    words than k, the whole sequence is the one shingle. Null texts and texts without words have an empty set and
    link with nothing. Rows without an id link with nothing and have no component. An id is one document: repeated
    rows are all returned and have one component. Other columns are left out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = texts_of(docs, id_column, text_column)
    last = frequent(rows, k)
    sets = prefixes(rows, k, part, whole, last)
    known = sets.where("doc IS NOT NULL AND n > 0")
    n, total = (x or 0 for x in known.agg(F.count(F.lit(1)), F.sum("n")).first())
    # So long are the first shingles of all sets together, at most.
    indexed = total * (whole - part) // whole + n
    classes = settled(known.groupBy("digest").agg(F.min("doc").alias("rep")), "shingle-classes", n)
    copies = settled(known.select("doc", "digest").join(classes, "digest").where("doc != rep").select("doc"), "shingle-copies", n)
    # Only those that may be copies travel to their names.
    seen = settle(marked(known.select("doc", "n", "first"), copies.select(F.col("doc").alias("rep")), MAP_BITS), "marked-prefixes")
    single = settle(seen.where("marked").join(copies, "doc", "left_anti"), "marked-classes")
    firsts = seen.where("NOT marked").unionByName(single).select("doc", F.col("n").cast("int").alias("n"), "first")
    # Most shingles are in one document only: find the others by counts before anything else travels.
    shared = firsts.select(F.explode("first").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("token")
    entries = firsts.select(F.col("doc").alias("rep"), "n", F.posexplode("first").alias("at", "token"))
    lists = settled(entries.join(shared, "token"), "shingle-index", indexed)
    lists = lists.withColumns({"leader": F.lit(0).cast("long"), "weight": 2 * part * F.col("n").cast("long"), "met": F.lit(0), "m": F.lit(1)})
    lists = settled(with_met(settled(merged(lists), "shingle-merged", indexed)), "shingle-counted", indexed)
    links = labels = None
    release(spark)

    def join_up(found, n):
        nonlocal links, labels
        found = settled(found, "links", n)
        release(spark)
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(spark, links)

    for turn in range(TURNS):
        lists = mixed_lists(lists, labels, "shingle-lists", part, whole, indexed)
        pairs = settled(plausible(leaders(lists, turn, part, whole, n), known, part, whole), "leader-candidates", n)
        join_up(linked(pairs, whole_sets(rows, ends_of(pairs), k, MAP_BITS), part, whole), total // HEAVY)
    for turn in range(MOST + 1):
        lists = mixed_lists(lists, labels, "lists-left", part, whole, lists.count())
        left = lists.count()
        if not left:
            break
        short, long, few = lists, None, LATER if turn else SHORT
        if turn < MOST and not lists.where(F.col("size") > few).isEmpty():
            blocks = mixed_lists(size_blocks(lists.where(F.col("size") > few), part, whole), labels, "size-blocks", part, whole, 2 * left)
            short = lists.where(F.col("size") <= few).unionByName(blocks.where(F.col("size") <= few))
            long = grouped(blocks.where(F.col("size") > few), turn, 2 * left)
        met = (short.agg(F.sum("size")).first()[0] or 0) // 2
        met = settled(short_pairs(short, part, whole), "short-pairs", met)
        pairs = settled(plausible(met, known, part, whole), "short-candidates", met.count())
        wanted = ends_of(pairs) if long is None else ends_of(pairs).unionByName(long.select("rep"))
        whole_texts = whole_sets(rows, wanted, k, MAP_BITS)
        found = linked(pairs, whole_texts, part, whole)
        if long is not None:
            apart = differences(long, whole_texts, last, part, whole)
            found = found.unionByName(nearest_links(apart))
            lists = difference_lists(apart, turn, part, whole)
        join_up(found, total // HEAVY)
        if long is None:
            break
    if labels is None:
        labels = spark.createDataFrame([], "rep long, component long")
    found = (sets.select("doc", "n", "digest").join(classes, "digest", "left")
             .join(labels.withColumnRenamed("rep", "l_rep"), F.col("rep") == F.col("l_rep"), "left"))
    component = F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.coalesce("component", "rep")).otherwise(F.col("doc"))
    return found.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", k: int = 5, part: int = 80,
                whole: int = 100) -> DataFrame:
    """docs with the row of the smallest id of each component, all columns as they are. Rows without an id stay."""
    found = cluster(docs, id_column, text_column, k, part, whole)
    gone = found.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column)).distinct()
    return without(docs, gone, id_column, "near-copies")
