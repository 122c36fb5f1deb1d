"""K-d tree sharding: documents go to shards of nearly equal bytes that are close in their metadata.

A node that is to hold k shards is cut across its widest dimension at the place that parts its bytes as
floor(k / 2) : ceil(k / 2), until every leaf is one shard. Histograms find the places for all nodes of a level at
once: bytes per coordinate, then per hash bucket within the coordinate that is cut, per bucket within that bucket, and
per unit within that. A unit is all documents of one text, which no cut parts; only a text whose copies hold more than a
part of a shard by which shards may differ is dealt into several units.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermalis.llm.common import settle, text_bytes

#: Copies of a text stay together up to 1 / so many of a shard. Shards differ by half as much where such a unit is cut at.
UNITS_PER_SHARD = 16
#: Rows that are numbered in one task.
NUMBERED = 50_000
DIMENSIONS = ["size_place", "lang_place", "source_place"]
BUCKETS = 4096


def rows_of(docs: DataFrame) -> DataFrame:
    content = text_bytes("text")
    return docs.select(
        F.col("doc_id"), (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content).cast("long").alias("text_crc32"), F.unhex(F.sha2(content, 256)).alias("digest"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))


def units_of(rows: DataFrame, unit_bytes: int) -> DataFrame:
    """digest, n_salts, salt, weight and the coordinates of each unit."""
    texts = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.max("size").alias("one"),
                                       F.min("lang").alias("lang"), F.min("source").alias("source"))
    texts = texts.withColumn("n_salts", F.ceil(F.col("bytes") / unit_bytes).cast("int"))
    spread = texts.where("n_salts > 1").select("digest", "n_salts", "one", "lang", "source")
    salted = rows.drop("lang", "source").join(spread, "digest")
    pieces = (salted.groupBy("digest", "n_salts", salt_of().alias("salt"))
              .agg(F.sum("size").alias("weight"), F.max("one").alias("one"), F.min("lang").alias("lang"), F.min("source").alias("source")))
    whole = texts.where("n_salts <= 1").select("digest", "n_salts", F.lit(0).alias("salt"), F.col("bytes").alias("weight"),
                                               "one", "lang", "source")
    units = whole.unionByName(pieces)
    name = lambda c: F.pmod(F.xxhash64(c), F.lit(1024)).cast("int")
    return units.select("digest", "n_salts", "salt", "weight",
                        F.floor(64 * F.log2(F.col("one").cast("double"))).cast("int").alias("size_place"),
                        name("lang").alias("lang_place"), name("source").alias("source_place"),
                        F.shiftrightunsigned(F.xxhash64("digest"), 52).cast("int").alias("bucket"),
                        (F.shiftrightunsigned(F.xxhash64("digest"), 40) % BUCKETS).cast("int").alias("within"))


def salt_of():
    return F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("n_salts")).cast("int")


def nearest_cut(histogram: DataFrame, at: str) -> DataFrame:
    """For each node the last place (column at) that begins before the wished weight, and the weight before it."""
    along = Window.partitionBy("node").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    below = histogram.withColumn("below", F.coalesce(F.sum("weight").over(along), F.lit(0)))
    return (below.where((F.col("below") <= F.col("wish"))).groupBy("node")
            .agg(F.max_by(F.struct(at, "below"), F.col(at)).alias("cut"))
            .select("node", F.col(f"cut.{at}").alias(f"cut_{at}"), F.col("cut.below").alias(f"below_{at}")))


def shard_units(units: DataFrame, n_shards: int) -> DataFrame:
    """Adds the column shard to units.

    Tables of nodes have a row per node, so n_shards at most, and are broadcast.
    """
    bounds = units.agg(*[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).first()
    whole = {d: max(1, bounds[d] or 0) for d in DIMENSIONS}
    now = units.withColumns({"node": F.lit(0), "n_shards": F.lit(n_shards)})
    while n_shards > 1:
        # Node ids are first shards, so a level's nodes are told apart by them.
        spread = [F.struct(((F.max(d) - F.min(d)) / whole[d]).alias("extent"), F.lit(-i).alias("order"))
                  for i, d in enumerate(DIMENSIONS)]
        nodes = now.where("n_shards > 1").groupBy("node").agg(
            F.array_max(F.array(*spread)).alias("widest"), F.sum("weight").alias("node_weight"), F.max("n_shards").alias("k"))
        nodes = nodes.select("node", (-F.col("widest.order")).alias("dimension"),
                             (F.col("node_weight") * F.floor(F.col("k") / 2) / F.col("k")).alias("wish"))
        place = F.element_at(F.array(*DIMENSIONS), F.col("dimension") + 1)
        placed = now.join(F.broadcast(nodes), "node", "left").withColumn("place", place)
        open_ = placed.where("dimension IS NOT NULL")
        first = nearest_cut(open_.groupBy("node", "place").agg(F.sum("weight").alias("weight"), F.max("wish").alias("wish")), "place")
        inside, cuts = open_, first
        for at, deeper in (("place", "bucket"), ("bucket", "within"), ("within", None)):
            inside = inside.join(F.broadcast(cuts.select("node", f"cut_{at}", f"below_{at}")), "node").where(f"{at} = cut_{at}")
            inside = inside.withColumn("wish", F.col("wish") - F.col(f"below_{at}"))
            if deeper:
                found = nearest_cut(inside.groupBy("node", deeper).agg(F.sum("weight").alias("weight"), F.max("wish").alias("wish")), deeper)
                cuts = cuts.join(F.broadcast(found), "node")
        close = inside
        line = Window.partitionBy("node").orderBy("digest", "salt").rowsBetween(Window.unboundedPreceding, -1)
        last = (close.withColumn("before", F.coalesce(F.sum("weight").over(line), F.lit(0)))
                .where(F.col("before") + F.col("weight") / 2 <= F.col("wish"))
                .select("digest", "salt", F.lit(True).alias("below_cut")))
        spot, cut = F.struct("place", "bucket", "within"), F.struct("cut_place", "cut_bucket", "cut_within")
        moved = (placed.join(F.broadcast(cuts), "node", "left").join(last, ["digest", "salt"], "left")
                 .withColumn("lower", (spot < cut) | F.coalesce("below_cut", F.lit(False))))
        half = F.floor(F.col("n_shards") / 2).cast("int")
        split = F.col("n_shards") > 1
        now = settle(moved.select(
            *units.columns,
            F.when(split & ~F.col("lower"), F.col("node") + half).otherwise(F.col("node")).alias("node"),
            F.when(split & F.col("lower"), half).when(split, F.col("n_shards") - half).otherwise(F.col("n_shards")).alias("n_shards")),
            "kd-level")
        n_shards -= n_shards // 2
    return now.select(*units.columns, F.col("node").alias("shard"))


def numbered(rows: DataFrame, n_rows: int, group: str, order: str, out: str) -> DataFrame:
    """Adds gapless numbers from 0 within each group; no task numbers much more than NUMBERED rows."""
    parts = max(1, -(-n_rows // NUMBERED))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(order), F.lit(parts)).cast("int"))
    counts = dealt.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n_part"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "part", F.coalesce(F.sum("n_part").over(before), F.lit(0)).alias("offset"))
    row = F.row_number().over(Window.partitionBy(group, "part").orderBy(order))
    return (dealt.withColumn("row_in_part", row).join(offsets, [group, "part"])
            .withColumn(out, (F.col("offset") + F.col("row_in_part") - 1).cast("long")).drop("part", "row_in_part", "offset"))


def shard(docs: DataFrame, n_shards: int | None = 8, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: a row per input row, for n_shards shards or shards of target_bytes.

    size is the UTF-8 bytes of the text plus 1. Documents of one text share a shard, unless the text's copies or a
    place of the tree is larger than equal bytes allow. Null texts, languages and sources count as empty; null ids
    are numbered first. Repeated rows have a slot each. An empty table gives no rows. Other columns are left out.
    """
    rows = settle(rows_of(docs), "shard-rows")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    if target_bytes:
        n_shards = max(1, -(-total // target_bytes))
    units = settle(units_of(rows, max(1, total // (n_shards * UNITS_PER_SHARD))), "shard-units")
    placed = shard_units(units, n_shards).select("digest", "n_salts", "salt", "shard")
    salts = placed.where("n_salts > 1").select("digest", "n_salts").distinct()
    keyed = (rows.select("doc_id", "size", "text_crc32", "digest").join(salts, "digest", "left")
             .withColumn("n_salts", F.coalesce("n_salts", F.lit(1))).withColumn("salt", salt_of()))
    found = keyed.join(placed.drop("n_salts"), ["digest", "salt"])
    return numbered(found.select("doc_id", "size", "text_crc32", "shard"), count, "shard", "doc_id", "slot")
