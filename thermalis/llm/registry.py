"""The registered queries of this subpackage, and the DuckDB SQL that checks them."""

import public_tokenizers
from pyspark.sql import functions as F

from thermalis.llm import alignment, bpe, decontam, exact_dedup, ngram_join, packing, prefix_trie, quality, sharding, substring_dedup, urls, warc, word_bpe
from thermalis.llm.common import documents, pages


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def word_model() -> word_bpe.WordModel:
    return word_bpe.WordModel.read(public_tokenizers.path("word_bpe_49k.json"))


def tokenisers() -> alignment.Tokenisers:
    return alignment.Tokenisers.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                                     public_tokenizers.PATTERN)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(spark, sf_dir):
    """Documents that the labels call good."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op1_ngram_jaccard(spark, sf_dir):
    return ngram_join.cluster(documents(spark, sf_dir))


def op2_kneser_ney_quality(spark, sf_dir):
    return quality.classify(documents(spark, sf_dir), trusted(spark, sf_dir))


def op3_warc_chunks(spark, sf_dir):
    return warc.round_trip(pages(spark, sf_dir))


def op4_super_kmers(spark, sf_dir):
    found = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_packed_tokens(spark, sf_dir):
    vocab = vocabulary()
    packed = packing.write_packed(packing.pack(documents(spark, sf_dir), vocab.ranks, vocab.pattern, end=len(vocab.ranks)))
    return packed.withColumn("ids_sha256", F.sha2("ids", 256)).drop("ids")


def op6_template_decontamination(spark, sf_dir):
    return decontam.verdicts(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_byte_bpe(spark, sf_dir):
    return bpe.round_trip(documents(spark, sf_dir), vocabulary())


def op8_kd_sharding(spark, sf_dir):
    placed = sharding.shard(documents(spark, sf_dir), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op9_url_regression(spark, sf_dir):
    return urls.judge(pages(spark, sf_dir), urls.train(urls.labelled(spark)))


def op10_streaming_dedup(spark, sf_dir):
    found = exact_dedup.exact_groups(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_fragment_alignment(spark, sf_dir):
    return alignment.align(documents(spark, sf_dir), tokenisers())


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_word_bpe(spark, sf_dir):
    return word_bpe.round_trip(documents(spark, sf_dir), word_model())


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_kneser_ney_quality": op2_kneser_ney_quality,
    "op3_warc_chunks": op3_warc_chunks,
    "op4_super_kmers": op4_super_kmers,
    "op5_packed_tokens": op5_packed_tokens,
    "op6_template_decontamination": op6_template_decontamination,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_kd_sharding": op8_kd_sharding,
    "op9_url_regression": op9_url_regression,
    "op10_streaming_dedup": op10_streaming_dedup,
    "op11_fragment_alignment": op11_fragment_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_word_bpe": op13_word_bpe,
}

ORACLE_SQL: dict[str, str] = {
    "op10_streaming_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_prefix_trie": """
        WITH RECURSIVE
        crc_steps(i, k, v) AS (  -- the table of CRC-32 (reversed polynomial 0xEDB88320)
            SELECT i, 0, i FROM range(256) t(i)
            UNION ALL SELECT i, k + 1, xor(v // 2, 3988292384 * (v % 2)) FROM crc_steps WHERE k < 8),
        crc_table AS (SELECT i, v FROM crc_steps WHERE k = 8),
        ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
        crc(c, place, v) AS (
            SELECT c, 1, 4294967295::BIGINT FROM ids
            UNION ALL SELECT c, place + 1, xor(t.v, crc.v // 256) FROM crc
            JOIN crc_table t ON t.i = xor(crc.v % 256, ascii(substr(c::VARCHAR, place::INT, 1))) WHERE place <= length(c::VARCHAR)),
        plan AS (SELECT c, c - c % 20 AS base, xor(v, 4294967295) % 4 AS h FROM crc WHERE place = length(c::VARCHAR) + 1),
        own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                       row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
                FROM conversations WHERE conv_id IS NOT NULL),
        taken AS (SELECT plan.c, own.pos, own.role, own.text FROM plan JOIN own ON own.c = plan.base AND own.pos <= plan.h
                  UNION ALL SELECT plan.c, 1000 + own.pos, own.role, own.text FROM plan JOIN own USING (c) WHERE own.pos > plan.h),
        turns AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d,
                         length(role) || ':' || role || length(text) || ':' || text AS turn,
                         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM taken),
        paths AS (SELECT c, d, string_agg(turn, '') OVER (PARTITION BY c ORDER BY d) AS path, words FROM turns
                  UNION ALL SELECT c, 0, '', 0 FROM ids),
        ended AS (SELECT c, max(d) AS d FROM paths GROUP BY c),
        nodes AS (SELECT d, path, min(c) AS owner, count(*) AS n, any_value(words) AS words FROM paths GROUP BY d, path),
        placed AS (SELECT p.c, p.d, n.owner FROM paths p JOIN nodes n USING (d, path)),
        up AS (SELECT n.d, n.owner, p.owner AS parent, n.n, n.words FROM nodes n
               LEFT JOIN placed p ON p.c = n.owner AND p.d = n.d - 1),
        kids AS (SELECT d - 1 AS d, parent AS owner, count(*) AS n_children FROM up WHERE d > 0 GROUP BY ALL),
        below AS (SELECT a.d, a.owner, sum(CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves,
                         sum((u.n - 1) * u.words) AS saved_tokens
                  FROM up u JOIN placed a ON a.c = u.owner AND a.d <= u.d LEFT JOIN kids k ON k.d = u.d AND k.owner = u.owner
                  GROUP BY a.d, a.owner),
        ends AS (SELECT p.owner, p.d, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS ids FROM placed p JOIN ended e ON e.c = p.c AND e.d = p.d
                 GROUP BY ALL)
        SELECT u.owner AS conv_id, u.d AS depth, u.parent AS parent_conv_id, u.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
               b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM up u JOIN below b USING (d, owner) LEFT JOIN kids k USING (d, owner) LEFT JOIN ends e USING (d, owner)""",
}
