"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (codes, divergence, exactdup, langid, licences, minhash, mixing, neighbours, packing, pages, pieces, secrets,
               sharding)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_language_id": _over("documents", langid.op1_language_id),
    "op2_pieces": _over("documents", pieces.op2_pieces),
    "op3_mix": _over("documents", mixing.op3_mix),
    "op4_neighbours": _over("embeddings", neighbours.op4_neighbours),
    "op5_exact_dedup": _over("documents", exactdup.op5_exact_dedup),
    "op6_licences": _over("documents", licences.op6_licences),
    "op7_pages": _over("pages", pages.op7_pages),
    "op8_near_dedup": _over("documents", minhash.op8_near_dedup),
    "op9_secrets": _over("documents", secrets.op9_secrets),
    "op10_shards": _over("documents", sharding.op10_shards),
    "op11_divergence": _over("documents", divergence.op11_divergence),
    "op12_packing": _over("documents", packing.op12_packing),
    "op13_vector_codes": _over("embeddings", codes.op13_vector_codes),
}

ORACLES: dict[str, str] = {
    "op3_mix": mixing.ORACLE_SQL,
    "op5_exact_dedup": exactdup.ORACLE_SQL,
    "op6_licences": licences.ORACLE_SQL,
    "op9_secrets": secrets.ORACLE_SQL,
    "op10_shards": sharding.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
    "op13_vector_codes": codes.ORACLE_SQL,
}
