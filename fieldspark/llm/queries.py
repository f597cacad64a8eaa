"""The registered queries of the corpus operators, each over the whole of its tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import bpe, chunking, language, lines, mixing, phrases, simhash, substrings, tiling, trie, urls, warc, wrappers
from fieldspark.llm.common import shared_folder, small_batches, table


def _held_out() -> Column:
    """Whether a document is of the fold that language identification doesn't learn from."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    return F.coalesce(fold == 1, F.lit(False))

#: Wanted tokens of each domain, as shares of the corpus's tokens.
TARGETS = {"good": 0.95, "poor": 0.05, "toxic": 0.0}

#: Rules of the url filter: verdict, and host with path prefix.
RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def labelled_domains(documents: DataFrame, labels: DataFrame, most: int = 8_000) -> DataFrame:
    """(text, domain) of labelled documents: toxic ones, and others by their quality.

    The ``most`` labels with the smallest hashes are used, so that they can be sent to the texts."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    some = labels.select("doc_id", domain.alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(most)
    return documents.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "domain")


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    headers = warc.archived(table(spark, sf_dir, "pages"), folder, min_bytes=0)
    return headers.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    documents = table(spark, sf_dir, "documents")
    labelled = labelled_domains(documents, table(spark, sf_dir, "labels"))
    return mixing.mix(documents.select("doc_id", "text"), labelled, TARGETS, keep_text=False)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), window=35, digest=True)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)


def labelled_languages(documents: DataFrame) -> DataFrame:
    """(id, lang, text) of the rows that may be learnt from."""
    return documents.where(~_held_out()).select(F.col("doc_id").alias("id"), "lang", "text")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.neighbour_likeness(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    documents = table(spark, sf_dir, "documents")
    found = language.identify(documents.select("doc_id", "text"), labelled_languages(documents))
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_removed", digest)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return tiling.contamination(documents.select("doc_id", "text"), benchmark).drop("text")


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of conversations that start with the first turns of another, and all conversations."""
    convs = turns.select("conv").distinct()
    taken = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(9))
    base = F.col("conv") - F.col("conv") % 5
    own = turns.where((base == F.col("conv")) | (F.col("place") > taken))
    heads = turns.where(F.col("place") <= 8).withColumnRenamed("conv", "base")
    others = convs.where(base != F.col("conv")).select("conv", base.alias("base"), taken.alias("taken"))
    borrowed = others.join(heads, "base").where(F.col("place") <= F.col("taken"))
    return own.unionByName(borrowed.select(own.columns)), convs


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes_of(*rebuilt_conversations(trie.numbered(table(spark, sf_dir, "conversations"))))


def op12_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(documents, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return phrases.collocations(table(spark, sf_dir, "documents"), least=10, longest=3, absorbed_percent=50, per_language=2_000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_source_mixing": op2_source_mixing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_fingerprints": op5_fingerprints,
    "op6_url_filter": op6_url_filter,
    "op7_language_id": op7_language_id,
    "op8_simhash": op8_simhash,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe_tokens": op12_bpe_tokens,
    "op13_collocations": op13_collocations,
}
