"""The queries of this subpackage by name, and the SQL that must agree where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import (
    bpe,
    embedding_dedup,
    fill_middle,
    fingerprints,
    license_scan,
    minhash,
    mixing,
    neighbours,
    pii,
    quality,
    secret_scan,
    spelling,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_pii": pii.op1_pii,
        "op2_license_scan": license_scan.op2_license_scan,
        "op3_mixing": mixing.op3_mixing,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_minhash": minhash.op5_minhash,
        "op6_secret_scan": secret_scan.op6_secret_scan,
        "op7_bpe": bpe.op7_bpe,
        "op8_neighbours": neighbours.op8_neighbours,
        "op9_quality": quality.op9_quality,
        "op10_embedding_dedup": embedding_dedup.op10_embedding_dedup,
        "op11_spelling": spelling.op11_spelling,
        "op12_fingerprints": fingerprints.op12_fingerprints,
        "op13_fill_middle": fill_middle.op13_fill_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_url_filter": url_filter.OP4_SQL,
        "op5_minhash": minhash.OP5_SQL,
        "op10_embedding_dedup": embedding_dedup.OP10_SQL,
        "op11_spelling": spelling.OP11_SQL,
        "op13_fill_middle": fill_middle.OP13_SQL,
    }
