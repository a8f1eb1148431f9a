"""Queries of the operators (``opN_<name>``) and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, html_text, langid, minhash_dedup, mix, ngram_join, packing, pseudonyms, quality, toxicity, url_rules, vector_codes, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _labelled(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_join": _over("documents", ngram_join.groups),
        "op2_url_rules": _over("pages", url_rules.verdicts),
        "op3_packing": _over("documents", packing.packed),
        "op4_quality": _labelled(quality.verdicts),
        "op5_toxicity": _labelled(toxicity.scores),
        "op6_html_text": _over("pages", html_text.extracted),
        "op7_langid": _over("documents", langid.predictions),
        "op8_pseudonyms": _over("documents", pseudonyms.pseudonymised),
        "op9_mix": _over("documents", mix.taken),
        "op10_exact_dedup": _over("documents", exact_dedup.verdicts),
        "op11_minhash_dedup": _over("documents", minhash_dedup.groups),
        "op12_vector_codes": _over("embeddings", vector_codes.codes),
        "op13_whitening": _over("embeddings", whitening.components),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_rules": url_rules.SQL, "op9_mix": mix.SQL, "op10_exact_dedup": exact_dedup.SQL,
        "op12_vector_codes": vector_codes.SQL,
    }
