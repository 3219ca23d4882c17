"""The registered queries of this subpackage and their SQL.

Each ``opN_<name>(spark, sf_dir)`` applies one operator with its production
parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import (bpe, chat, decontaminate, divergence, lattice, mixing, order_minhash, pages, periodic, pii, repeats,
                         toxicity, warc)
from waymark.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]

#: Demonstration key of the registered query; jobs pass their own secret.
PII_KEY = "demonstration-key"
#: Vocabulary of op12, a file of the installed public tokenizers.
BPE_FILE = "byte_bpe_50k.tiktoken"


def op1_e8_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings"))


def op2_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of conversations in its repaired and rendered form."""
    return chat.format_chat(read(spark, sf_dir, "conversations"))


def op3_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contaminated (doc_id, item_id) pairs of all documents and benchmark items."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    return warc.archive(read(spark, sf_dir, "pages"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return order_minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents replicated to square-root-of-size target shares, one epoch, shuffled."""
    return mixing.replicate(read(spark, sf_dir, "documents"))


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with pseudonymised text and the number of values replaced."""
    return pii.pseudonymise(read(spark, sf_dir, "documents"), PII_KEY)


def op8_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = read(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def op9_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document once recurring 35-word windows are gone."""
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


def op10_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(read(spark, sf_dir, "pages"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every (lang, source) of documents from the others, and its own terms."""
    return divergence.divergence(read(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in the public 50k vocabulary, and what they decode to."""
    import public_tokenizers
    path, pattern = public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN
    tokens = bpe.encode(read(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(tokens, path, pattern).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, some with a planted periodic tail."""
    return periodic.digests(periodic.find(periodic.with_planted(read(spark, sf_dir, "documents"))))


QUERIES: dict[str, Query] = {
    "op1_e8_lattice": op1_e8_lattice,
    "op2_role_repair": op2_role_repair,
    "op3_spaced_seed_decontamination": op3_spaced_seed_decontamination,
    "op4_warc_dictionary": op4_warc_dictionary,
    "op5_order_minhash": op5_order_minhash,
    "op6_poisson_mixing": op6_poisson_mixing,
    "op7_pii_pseudonyms": op7_pii_pseudonyms,
    "op8_counterfactual_toxicity": op8_counterfactual_toxicity,
    "op9_repeated_phrases": op9_repeated_phrases,
    "op10_template_extraction": op10_template_extraction,
    "op11_source_divergence": op11_source_divergence,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op3_spaced_seed_decontamination": decontaminate.oracle(),
    "op4_warc_dictionary": warc.oracle(),
    "op6_poisson_mixing": mixing.oracle(),
    "op11_source_divergence": divergence.oracle(),
}
