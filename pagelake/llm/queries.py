"""The registered queries of this subpackage, over the whole documents table, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, language_id, line_quality, mixing, nbsvm, neardup, packing, prefix_trie, secret_scan, sharding, simhash_index, toxicity, warc_store
from .common import documents, labels, table


def _over_documents(query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(documents(spark, sf_dir))


def _over_labels(query: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(documents(spark, sf_dir), labels(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _over_documents(mixing.query),
    "op2_secret_scan": _over_documents(secret_scan.query),
    "op3_fingerprints": _over_documents(simhash_index.query),
    "op4_simhash_near_dedup": _over_documents(neardup.query),
    "op5_sharding": _over_documents(sharding.query),
    "op6_best_fit_packing": _over_documents(packing.query),
    "op7_language_id": _over_documents(language_id.query),
    "op8_quality_rules": _over_documents(line_quality.query),
    "op9_quality_classifier": _over_labels(nbsvm.query),
    "op10_toxicity": _over_labels(toxicity.query),
    "op11_collocations": _over_documents(collocations.query),
    "op12_warc": lambda spark, sf_dir: warc_store.query(table(spark, sf_dir, "pages")),
    "op13_prefix_trie": lambda spark, sf_dir: prefix_trie.query(table(spark, sf_dir, "conversations")),
}

# where SQL can't express the operator, tests/llm holds it against a brute-force form
ORACLES: dict[str, str] = {"op8_quality_rules": line_quality.SQL, "op11_collocations": collocations.SQL, "op12_warc": warc_store.SQL, "op13_prefix_trie": prefix_trie.SQL}
