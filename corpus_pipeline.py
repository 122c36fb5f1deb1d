"""The corpus pipeline: quality, exact copies, near copies, benchmark passages, tokens.

Every stage takes the documents that its predecessor kept and returns those that it keeps, with the columns of
documents; the last returns their tokens. Between stages the documents are a Parquet table.
"""

from pyspark.sql import functions as F

from thermalis.llm import bpe, decontam, exact_dedup, ngram_join, quality, registry
from thermalis.llm.common import settle


def quality_classifier(spark, docs, sf_dir):
    """Documents whose perplexity is within the fence of their language."""
    return quality.good_documents(docs, registry.trusted(spark, sf_dir))


def exact_copies(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.dedup(docs)


def near_copies(spark, docs, sf_dir):
    """Of documents that 5-word shingles link at a similarity of 0.8 or more, the one with the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def benchmark_passages(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontam.clean_documents(docs, registry.table(spark, sf_dir, "benchmark"))


def tokens(spark, docs, sf_dir):
    """doc_id, n_tokens, ids (little-endian 32-bit), decoded_sha256 of the bytes that the ids decode to."""
    vocabulary = registry.vocabulary()
    # A table between the two: else every task has a Python worker for each, and both keep their memory for the next stages.
    coded = settle(bpe.encode(docs, vocabulary), "tokens")
    back = bpe.decode(coded, vocabulary)
    return back.select("doc_id", "n_tokens", "ids", F.sha2("text_bytes", 256).alias("decoded_sha256"))


STAGES = [("quality classifier", quality_classifier), ("exact dedup", exact_copies), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", benchmark_passages), ("byte-level BPE", tokens)]

#: Perplexities, component search and merges by rank are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, one after the other, over all documents."""
    docs = registry.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
