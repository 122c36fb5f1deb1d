"""Exact deduplication by a stream with keyed state.

Digests of the texts flow through a streaming aggregation whose state lives in RocksDB on the executors' disks,
backed by the checkpoint folder, and never expires: per digest the keeper's identifier and content locator and the
number of rows. The state is read back as a table. Rows that hit an existing digest are compared with the keeper's
full bytes; rows that differ in spite of equal digests form groups of their own. Texts without a hit do not travel: a bit
map of fixed size holds them back.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thermalis.llm.common import scratch_path, settle, text_bytes

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Files of fingerprints per micro-batch.
FILES_PER_BATCH = 64
#: log2 of the bits of the map of digests with hits. A full map holds nothing back, and changes no result.
MAP_BITS = 23


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def with_content(docs: DataFrame, id_column: str, text_column: str, digest) -> DataFrame:
    rows = docs.select(F.col(id_column).alias("id"), text_bytes(text_column).alias("content"))
    return rows.withColumn("digest", digest(F.col("content")))


def fingerprints(rows: DataFrame) -> DataFrame:
    """id, digest and content locator (file and length) of each row, as a table."""
    located = rows.select("id", "digest", F.input_file_name().alias("file"), F.octet_length("content").cast("long").alias("n_bytes"))
    return settle(located, "fingerprints")


def stream_state(spark: SparkSession, arriving: DataFrame, checkpoint: str) -> DataFrame:
    """Run a stream of (id, digest, file, n_bytes) until all that is there has been taken in; return its state.

    The state has a row per digest: digest, keep_id (the largest id), located (id, file, n_bytes of the keeper),
    group_size. A later call with the same checkpoint folder goes on from the state that is there. arriving must be
    a streaming DataFrame of a session from state_session().
    """
    grouped = arriving.groupBy("digest").agg(F.max(F.struct("id", "file", "n_bytes")), F.count(F.lit(1)))
    query = (grouped.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    state = spark.read.format("statestore").load(checkpoint)
    located, size = state.schema["value"].dataType.names
    return state.select("key.digest", F.col(f"value.`{located}`.id").alias("keep_id"),
                        F.col(f"value.`{located}`").alias("located"), F.col(f"value.`{size}`").alias("group_size"))


def state_session(spark: SparkSession) -> SparkSession:
    """A session like spark whose streams keep their state in RocksDB.

    A store is closed after each batch: an open one holds some MB of pre-allocated files, however few keys it has.
    """
    session = spark.newSession()
    for key, value in (("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
                       ("spark.sql.streaming.stateStore.providerClass", ROCKSDB),
                       ("spark.sql.streaming.stateStore.unloadOnCommit", "true"),
                       ("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"),
                       ("spark.sql.streaming.noDataMicroBatches.enabled", "false")):
        session.conf.set(key, value)
    return session


def bit_of(digest: str) -> Column:
    return F.xxhash64(digest).bitwiseAND(F.lit((1 << MAP_BITS) - 1))


def hit_map(digests: DataFrame) -> Column:
    """2**MAP_BITS bits as an array of numbers, set for the digests, as one value of a query."""
    words = (digests.select(bit_of("digest").alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("mask")))
    every = digests.sparkSession.range(max(1, 1 << MAP_BITS >> 6)).select(F.col("id").alias("word"))
    filled = every.join(words, "word", "left").select(F.struct("word", F.coalesce("mask", F.lit(0)).alias("mask")).alias("entry"))
    return settle(filled.agg(F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["mask"]).alias("map")), "dedup-map").scalar()


def may_hit(digest: str, table: Column) -> Column:
    bit = bit_of(digest)
    return F.getbit(F.element_at(table, (F.shiftright(bit, 6) + 1).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest=sha256,
                 files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """id, keep_id, group_size, kept, digest: a row for each distinct pair of id and text.

    Of rows with the same text the largest id stays. Null text counts as empty text; a null id comes before all
    others. Repeated rows count in group_size but have one row here. digest may be any function of the bytes: groups
    hold equal texts even where it collides. Other columns are left out.
    """
    spark = docs.sparkSession
    rows = with_content(docs, id_column, text_column, digest)
    prints = fingerprints(rows)
    taking_in = state_session(spark)
    path = prints.inputFiles()[0].rsplit("/", 1)[0] if prints.inputFiles() else None
    if path is None:
        state = spark.createDataFrame([], f"digest {prints.schema['digest'].dataType.simpleString()}, "
                                          f"keep_id {prints.schema['id'].dataType.simpleString()}, group_size long")
    else:
        arriving = taking_in.readStream.schema(prints.schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        state = settle(stream_state(spark, arriving, scratch_path(spark, "dedup-state"))
                       .select("digest", "keep_id", "group_size"), "dedup-groups")
    # Full bytes of all rows that share a digest, once; the keeper's are compared with the rest.
    shared = state.where("group_size > 1")
    hits = settle(rows.where(may_hit("digest", hit_map(shared))).join(shared, "digest"), "dedup-hits")
    keeper = settle(hits.where(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("digest")
                    .agg(F.max("content").alias("kept_content")), "dedup-keepers")
    other = hits.join(keeper, "digest").where("content != kept_content").select("id", "digest", "content")
    other = settle(other, "dedup-collisions")
    regrouped = other.groupBy("digest", "content").agg(F.max("id").alias("other_id"), F.count(F.lit(1)).alias("other_size"))
    moved = (other.join(regrouped, ["digest", "content"]).groupBy("id", "digest", "content")
             .agg(F.max("other_id").alias("keep_id"), F.max("other_size").alias("group_size"))
             .select("id", "digest", "keep_id", "group_size"))
    left = other.groupBy("digest").agg(F.count(F.lit(1)).alias("n_moved"))
    gone = other.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n_gone"))
    stay = (prints.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n_rows"))
            .join(gone.select(F.col("id").alias("gone_id"), F.col("digest").alias("gone_digest"), "n_gone"),
                  F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("digest") == F.col("gone_digest")), "left")
            .where("n_gone IS NULL OR n_gone < n_rows")
            .join(state, "digest").join(left, "digest", "left")
            .select("id", "digest", "keep_id", (F.col("group_size") - F.coalesce("n_moved", F.lit(0))).alias("group_size")))
    found = stay.unionByName(moved)
    return found.select(F.col("id").alias(id_column), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with one row of each group of equal texts, all columns as they are; of repeated rows one stays, any one."""
    found = exact_groups(docs, id_column, text_column).where("group_size > 1")
    found = settle(found.select(F.col(id_column).alias("found_id"), F.col("digest").alias("found_digest"), "kept"), "dedup-report")
    # Rows travel as one column, so no name of theirs can clash with those here.
    marked = docs.select(F.struct("*").alias("row"), F.col(id_column).alias("id"), sha256(text_bytes(text_column)).alias("digest"))
    hit = may_hit("digest", hit_map(found.select(F.col("found_digest").alias("digest"))))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("digest") == F.col("found_digest"))
    rest = marked.where(hit).join(found, same, "left").where("kept IS NULL OR kept")
    # Only keepers of groups can be repeated rows.
    once = rest.where("kept").dropDuplicates(["id", "digest"])
    return marked.where(~hit).unionByName(rest.where("kept IS NULL").select(marked.columns)).unionByName(once.select(marked.columns)).select("row.*")
