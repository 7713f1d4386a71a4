"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm import (convtrie, decontaminate, jaccard, language, licenses, lines, mixing, pii, secrets, simhash,
                          substrings, tokenalign, topk)
from tidemark.sources.tables import load


def _documents(spark, sf_dir):
    return load(spark, sf_dir, "documents")


def op1_mix_sources(spark, sf_dir):
    """All documents mixed to source weights by a splitting tree of quotas."""
    return mixing.digest(_documents(spark, sf_dir))


def op2_line_dedup(spark, sf_dir):
    """Lines of ten or more documents dropped, with reference counts."""
    return lines.digest(_documents(spark, sf_dir))


def op3_pii(spark, sf_dir):
    """Personal data by candidates, boosted trees and calibrated thresholds."""
    return pii.digest(_documents(spark, sf_dir))


def op4_language_id(spark, sf_dir):
    """Languages by a bidirectional recurrent network over bytes."""
    return language.digest(_documents(spark, sf_dir))


def op5_simhash(spark, sf_dir):
    """SimHash fingerprints and groups of near duplicates."""
    return simhash.digest(_documents(spark, sf_dir))


def op6_decontaminate(spark, sf_dir):
    """Documents and the benchmark items found in them."""
    return decontaminate.digest(_documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark, sf_dir):
    """Words of 13-word windows that smaller documents hold, removed."""
    return substrings.digest(_documents(spark, sf_dir))


def op8_license_scan(spark, sf_dir):
    """License phrases and notices by diagonal voting."""
    return licenses.digest(_documents(spark, sf_dir))


def op9_secret_scan(spark, sf_dir):
    """Secrets that a random forest keeps among candidate tokens."""
    return secrets.digest(_documents(spark, sf_dir))


def op10_top_k(spark, sf_dir):
    """The 20 best inner products of each twentieth vector."""
    return topk.digest(load(spark, sf_dir, "embeddings"))


def op11_jaccard_join(spark, sf_dir):
    """Groups of documents whose sets of word shingles are alike."""
    return jaccard.digest(_documents(spark, sf_dir))


def op12_prefix_trie(spark, sf_dir):
    """The prefix trie of the rebuilt conversations."""
    return convtrie.digest(load(spark, sf_dir, "conversations"))


def op13_token_alignment(spark, sf_dir):
    """Tokens of two tokenizers linked by the bytes they share."""
    return tokenalign.digest(_documents(spark, sf_dir))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_line_dedup": op2_line_dedup,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_simhash": op5_simhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_secret_scan": op9_secret_scan,
    "op10_top_k": op10_top_k,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL = {
    "op1_mix_sources": mixing.ORACLE,
    "op2_line_dedup": lines.ORACLE,
    "op7_substring_dedup": substrings.ORACLE,
    "op10_top_k": topk.ORACLE,
    "op12_prefix_trie": convtrie.ORACLE,
}
