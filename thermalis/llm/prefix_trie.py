"""Prefix trie of conversations, by blocks of turns.

Conversations are grouped by their successive blocks of BLOCK turns first: a block is known by the hash of its turns and
of all turns before it, so one aggregation finds the distinct blocks below each prefix. Turn boundaries are refined only
inside blocks whose prefix is followed by several different blocks; a lone block is a straight run of nodes.

A node belongs to its smallest member. The members of a node's child are some of its own, so a conversation owns one run
of nodes that ends with its last turn, and hangs with its head on a node of another owner. Sums over subtrees go up that
tree of owners by pointer doubling, so the number of rounds is the logarithm of its height.

Turns are compared by SHA-256, prefixes by 128 bits made of these. A conversation's turns are numbered and summed by
windows, which spill; nothing else gathers the rows of a conversation, a prefix or a node.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermalis.llm.common import bounded_batches, settle, streamed_sha256

#: Turns of a block.
BLOCK = 4
WORD = r"[^\x20\x09-\x0D]+"


def digested(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
             text_column: str = "text") -> DataFrame:
    """conv, turn, digest (of role and text, null as empty), words: a row per turn that has a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_column, text_column))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return (conversations.where(F.col(id_column).isNotNull())
            .select(F.col(id_column).cast("long").alias("conv"), F.col(turn_column).alias("turn"),
                    F.unhex(F.sha2(content, 256)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))


def numbered(turns: DataFrame) -> DataFrame:
    """conv, pos, digest, words: turns from 1 on in the order of turn, null first; ties in the order of their digests."""
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    return turns.select("conv", F.row_number().over(order).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, members: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """conv, pos, digest, words: numbered turns after a shared opening was put in place of each conversation's own.

    The first h turns of conversation c - c % group come first, then those of c after its first h; h is the CRC-32 of
    c's decimal form modulo most.
    """
    c = F.col("conv")
    recipes = members.select("conv", (c - c % group).alias("base"), (F.crc32(c.cast("string")) % most).cast("int").alias("h"))
    openings = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    borrowed = openings.join(recipes, "base").where("pos <= h").select("conv", "pos", "digest", "words")
    lengths = openings.groupBy("base").agg(F.max("pos").alias("there"))
    plan = recipes.join(lengths, "base", "left").select("conv", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"))
    own = turns.join(plan, "conv").where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "words")
    return borrowed.unionByName(own)


def keyed(turns: DataFrame) -> DataFrame:
    """Adds z1, z2: 128 bits of each turn at its place. A prefix is known by their exclusive or."""
    return turns.select("conv", "pos", "words", F.xxhash64("pos", "digest").alias("z1"),
                        F.xxhash64(F.lit(11), "pos", "digest").alias("z2"))


def distinct_blocks(turns: DataFrame, size: int) -> DataFrame:
    """block, p1, p2 (the prefix before it), turns, n, owner: the different blocks below each prefix."""
    blocks = (turns.groupBy("conv", F.floor((F.col("pos") - 1) / size).cast("int").alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("pos", "z1", "z2", "words"))).alias("turns"),
                   F.bit_xor("z1").alias("b1"), F.bit_xor("z2").alias("b2")))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumns({p: F.coalesce(F.bit_xor(b).over(before), F.lit(0).cast("long")) for p, b in (("p1", "b1"), ("p2", "b2"))})
    return (placed.groupBy("block", "p1", "p2", "b1", "b2")
            .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("owner"), F.any_value("turns").alias("turns")).drop("b1", "b2"))


def boundaries(blocks: DataFrame) -> DataFrame:
    """depth, k1, k2, up1, up2 (its parent's key), words, n, owner: a row per turn of each block."""
    def key(part: str, start: str, upto: Column) -> Column:
        return F.aggregate(F.slice("turns", 1, upto), F.col(start), lambda acc, t: acc.bitwiseXOR(t[part]))

    rows = blocks.withColumn("at", F.explode(F.sequence(F.lit(1), F.size("turns"))))
    turn = F.element_at("turns", F.col("at"))
    return rows.select(turn["pos"].alias("depth"), key("z1", "p1", F.col("at")).alias("k1"), key("z2", "p2", F.col("at")).alias("k2"),
                       key("z1", "p1", F.col("at") - 1).alias("up1"), key("z2", "p2", F.col("at") - 1).alias("up2"),
                       turn["words"].alias("words"), "n", "owner")


def nodes_below_root(turns: DataFrame, size: int) -> DataFrame:
    """The nodes of the trie but its root: depth, k1, k2, up1, up2, words, n, owner."""
    blocks = settle(distinct_blocks(turns, size), "trie-blocks")
    # What follows the root nearly always diverges, and would be one hot key below.
    first, later = blocks.where("block = 0"), blocks.where("block > 0")
    siblings = later.groupBy("block", "p1", "p2").agg(F.count(F.lit(1)).alias("siblings"))
    later = later.join(siblings, ["block", "p1", "p2"])
    straight = boundaries(later.where("siblings = 1"))
    diverging = boundaries(first.unionByName(later.where("siblings > 1").drop("siblings")))
    same = [F.any_value(c).alias(c) for c in ("up1", "up2", "words")]
    refined = diverging.groupBy("depth", "k1", "k2").agg(*same, F.sum("n").alias("n"), F.min("owner").alias("owner"))
    return straight.unionByName(refined)


def subtree_totals(owners: DataFrame) -> DataFrame:
    """owner, saved, leaves with those of all owners that hang on it, directly or not. owners: owner, up, saved, leaves."""
    now = settle(owners, "trie-owners")
    while not now.where("up IS NOT NULL").isEmpty():
        # Each has the sums of 2**k generations; the pointer skips as many.
        heard = (now.where("up IS NOT NULL").groupBy(F.col("up").alias("h_owner"))
                 .agg(F.sum("saved").alias("h_saved"), F.sum("leaves").alias("h_leaves")))
        above = now.where("up IS NOT NULL").select(F.col("owner").alias("a_owner"), F.col("up").alias("a_up"))
        jumped = now.join(above, F.col("up") == F.col("a_owner"), "left")
        now = settle(jumped.join(heard, F.col("owner") == F.col("h_owner"), "left")
                     .select("owner", F.col("a_up").alias("up"), (F.col("saved") + F.coalesce("h_saved", F.lit(0))).alias("saved"),
                             (F.col("leaves") + F.coalesce("h_leaves", F.lit(0))).alias("leaves")), "trie-owners")
    return now.select("owner", "saved", "leaves")


def trie(turns: DataFrame, members: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The nodes of numbered turns, and where the members end.

    Nodes: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens. Ends: conv_id,
    depth of a node, and conv, a member that has no further turn. members: conv, every conversation, also without turns;
    without members there are no nodes. (conv_id, depth) tells nodes apart.
    """
    turns = settle(keyed(turns), "trie-turns")
    count, least = members.agg(F.count(F.lit(1)), F.min("conv")).first()
    spark = turns.sparkSession
    root = spark.createDataFrame([(0, 0, 0, None, None, 0, count, least)] if count else [],
                                 "depth int, k1 long, k2 long, up1 long, up2 long, words long, n long, owner long")
    nodes = settle(nodes_below_root(turns, size).unionByName(root), "trie-nodes")
    cost = (F.col("n") - 1) * F.col("words")
    runs = settle(nodes.groupBy("owner").agg(F.min(F.struct("depth", "up1", "up2")).alias("head"), F.max("depth").alias("last"),
                                             F.sum(cost).alias("saved")), "trie-runs")
    heads = runs.where("head.depth > 0").select("owner", (F.col("head.depth") - 1).alias("depth"), F.col("head.up1").alias("k1"), F.col("head.up2").alias("k2"))
    on_root = heads.where("depth = 0").select("owner", "depth", F.lit(least).cast("long").alias("up"))
    deeper = heads.where("depth > 0").join(nodes.select("depth", "k1", "k2", F.col("owner").alias("up")), ["depth", "k1", "k2"])
    hung = settle(on_root.unionByName(deeper.select("owner", "depth", "up")), "trie-hung")
    branching = hung.groupBy(F.col("up").alias("b_owner"), F.col("depth").alias("b_depth")).agg(F.count(F.lit(1)).alias("branches"))
    linked = (runs.join(hung.select(F.col("owner").alias("h_owner"), "up"), F.col("owner") == F.col("h_owner"), "left")
              .join(branching, (F.col("owner") == F.col("b_owner")) & (F.col("last") == F.col("b_depth")), "left"))
    totals = subtree_totals(linked.select("owner", "up", "saved", F.col("branches").isNull().cast("long").alias("leaves")))
    # What hangs on a node counts for it and for the nodes of its run above it.
    gained = (hung.join(totals, "owner").groupBy(F.col("up").alias("owner"), "depth")
              .agg(F.count(F.lit(1)).alias("branches"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")))
    own = nodes.select("owner", "depth", F.lit(0).cast("long").alias("branches"), cost.alias("saved"), F.lit(0).cast("long").alias("leaves"), "n")
    both = own.unionByName(gained, allowMissingColumns=True).groupBy("owner", "depth").agg(
        *[F.sum(c).alias(c) for c in ("branches", "saved", "leaves")], F.max("n").alias("n"))
    ends_here = (F.col("depth") == F.col("last")) & (F.col("branches") == 0)
    below = Window.partitionBy("owner").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    marked = (both.join(runs.select("owner", F.col("head.depth").alias("top"), "last"), "owner")
              .join(hung.select("owner", "up"), "owner", "left").withColumn("leaf", ends_here.cast("long")))
    found = marked.select(
        F.col("owner").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") > F.col("top"), F.col("owner")).otherwise(F.col("up")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("branches") + (F.col("depth") < F.col("last")).cast("long")).alias("n_children"),
        F.sum(F.col("leaves") + F.col("leaf")).over(below).alias("n_leaves"), F.sum("saved").over(below).alias("saved_tokens"))
    whole = turns.groupBy("conv").agg(F.max("pos").alias("depth"), F.bit_xor("z1").alias("k1"), F.bit_xor("z2").alias("k2"))
    some = whole.join(nodes.select("depth", "k1", "k2", "owner"), ["depth", "k1", "k2"]).select("owner", "depth", "conv")
    none = members.join(whole.select("conv"), "conv", "left_anti").select(F.lit(least).cast("long").alias("owner"), F.lit(0).alias("depth"), "conv")
    ends = some.unionByName(none).select(F.col("owner").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "conv")
    return found, ends


def members_of(turns: DataFrame) -> DataFrame:
    return settle(turns.select("conv").distinct(), "trie-members")


def prefix_trie(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role",
                text_column: str = "text", size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The trie of conversations as they are: nodes and ends, see trie().

    Rows without a conversation are left out; null roles and texts are empty. Repeated rows are repeated turns. Other
    columns are left out.
    """
    turns = digested(conversations, id_column, turn_column, role_column, text_column)
    return trie(numbered(turns), members_of(turns), size)


def rebuilt_trie(conversations: DataFrame, size: int = BLOCK) -> DataFrame:
    """The trie of conversations with shared openings (see rebuilt), with ends_sha256: the SHA-256 of the ids of the
    members that end at a node, in decimal, ascending, joined by commas."""
    bounded_batches(conversations.sparkSession)
    turns = digested(conversations)
    members = members_of(turns)
    nodes, ends = trie(rebuilt(settle(numbered(turns), "trie-numbered"), members), members, size)
    digests = streamed_sha256(ends.withColumn("content", F.col("conv").cast("string").cast("binary")), ["conv_id", "depth"], "conv", b",")
    return (nodes.join(digests.withColumnRenamed("sha256", "ends_sha256"), ["conv_id", "depth"], "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))))
