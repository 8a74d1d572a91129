"""Queries of the training-data operators and the SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: query name -> (module, function); each function takes (spark, sf_dir)
_ENTRIES = {
    "op1_lm_scoring": "lm_nce",
    "op2_token_store": "token_store",
    "op3_decontamination": "decontaminate",
    "op4_toxicity": "toxicity",
    "op5_pii": "pii",
    "op6_ngram_jaccard_join": "jaccard_join",
    "op7_main_text": "main_text",
    "op8_exact_topk": "exact_topk",
    "op9_best_fit_packing": "packing",
    "op10_warc_store": "warc_store",
    "op11_minhash_near_dedup": "minhash_tensor",
    "op12_embedding_whitening": "whitening",
    "op13_periodic_runs": "periodic_runs",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
for _name, _module in _ENTRIES.items():
    _m = import_module(f".{_module}", __package__)
    QUERIES[_name] = _m.query
    if getattr(_m, "ORACLE_SQL", None):
        ORACLE[_name] = _m.ORACLE_SQL
