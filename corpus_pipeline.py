"""A corpus pipeline of five operators, each stage on all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.llm.bpe import encode_documents
from strataframe.llm.common import content_key, drop_staged, scratch, staged, table
from strataframe.llm.jaccard import jaccard_components
from strataframe.llm.mixing import mixed_documents
from strataframe.llm.quality import quality_rules
from strataframe.llm.secret_scan import redacted
from strataframe.session import broadcast_if_small

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
NEAR_WIDTH, NEAR_PERCENT = 5, 80  # near duplicates: words of a shingle, least similarity
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source.

    Null texts count as empty and go, as does every text that fails; of equal rows all stay or none.
    """
    key = content_key("lang", "source", "text")  # a verdict depends on these alone
    with scratch() as held:
        judged = quality_rules(docs.select(key.alias("_key"), "lang", "source", "text"), "_key")
        rejected = held.keep(staged(judged.filter(~F.col("kept")).select("_key").distinct(), "quality-rejected"))
    return docs.select(*COLUMNS, key.alias("_key")).join(broadcast_if_small(rejected), "_key", "left_anti").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones, the one with the smallest doc_id.

    Rows that share a doc_id count once if they are equal in all columns, else all of them stay or
    go together.  Rows without doc_id stay, and so do null, blank and empty texts, which link with nothing.
    """
    with scratch() as held:
        groups = jaccard_components(docs, NEAR_WIDTH, NEAR_PERCENT)
        gone = held.keep(staged(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "near-gone"))
        often = held.keep(staged(groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "near-repeated"))
    left = docs.select(*COLUMNS).join(broadcast_if_small(gone), "doc_id", "left_anti").select(*COLUMNS)
    if often.isEmpty():
        return left
    often = broadcast_if_small(often)
    return left.join(often, "doc_id", "left_anti").select(*COLUMNS).union(left.join(often, "doc_id", "left_semi").select(*COLUMNS).distinct())


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; null texts stay null, rows without secrets are unchanged."""
    return redacted(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passes over documents that the mix takes; a document may come more than once, null and blank texts never.

    Null is a source of its own.
    """
    return mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every pass, with their number and the digest of the bytes decoded from them; null texts have none."""
    encoded = encode_documents(docs, "doc_id", "source", vocabulary=VOCABULARY, pattern=public_tokenizers.PATTERN)
    return encoded.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

# the outlier fits are iterative and the forest is trained, so no SQL gives these rows
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read again before the next.

    What a stage stages goes once its rows are written, and these once the next stage's are; on failure all goes.
    An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    with scratch() as whole:
        for name, stage in STAGES:
            before = docs
            with scratch() as held:
                docs = held.keep(staged(stage(spark, docs, sf_dir), name.replace(" ", "-")))
            if hasattr(before, "_scratch_path"):
                drop_staged(before)
        return whole.keep(docs)
