"""The registered queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.decontam import op3_decontaminate
from starloom.llm.hashtree import op5_hash_tree
from starloom.llm.hostrules import op2_host_rules
from starloom.llm.jaccard import op1_jaccard_join
from starloom.llm.langid import op10_langid
from starloom.llm.merkle import op13_merkle_manifest
from starloom.llm.oracle import ORACLE  # noqa: F401
from starloom.llm.packing import op6_best_fit
from starloom.llm.pii import op9_pii
from starloom.llm.ranked import op11_ranked_search
from starloom.llm.secretscan import op12_secret_scan
from starloom.llm.templates import op8_template_removal
from starloom.llm.tokencount import op7_token_counts
from starloom.llm.tokenstore import op4_token_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_host_rules": op2_host_rules,
    "op3_decontaminate": op3_decontaminate,
    "op4_token_store": op4_token_store,
    "op5_hash_tree": op5_hash_tree,
    "op6_best_fit": op6_best_fit,
    "op7_token_counts": op7_token_counts,
    "op8_template_removal": op8_template_removal,
    "op9_pii": op9_pii,
    "op10_langid": op10_langid,
    "op11_ranked_search": op11_ranked_search,
    "op12_secret_scan": op12_secret_scan,
    "op13_merkle_manifest": op13_merkle_manifest,
}
