"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchcredit.llm import audit, chat, decontam, langid, lines, lm, minhash, mixing, neighbours, pieces, resample, tokens, toxicity
from touchcredit.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    named = {
        "op1_toxicity": toxicity.op1_toxicity,
        "op2_language_id": langid.op2_language_id,
        "op3_decontamination": decontam.op3_decontamination,
        "op4_context_mixing": lm.op4_context_mixing,
        "op5_pareto_mix": mixing.op5_pareto_mix,
        "op6_near_dedup": minhash.op6_near_dedup,
        "op7_nn_descent": neighbours.op7_nn_descent,
        "op8_token_output": tokens.op8_token_output,
        "op9_chat_format": chat.op9_chat_format,
        "op10_line_dedup": lines.op10_line_dedup,
        "op11_sentencepiece": pieces.op11_sentencepiece,
        "op12_importance_resampling": resample.op12_importance_resampling,
        "op13_filter_audit": audit.op13_filter_audit,
    }
    return {name: _ready(query) for name, query in named.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": decontam.OP3_SQL,
        "op5_pareto_mix": mixing.OP5_SQL,
        "op9_chat_format": chat.OP9_SQL,
        "op10_line_dedup": lines.OP10_SQL,
        "op12_importance_resampling": resample.OP12_SQL,
        "op13_filter_audit": audit.OP13_SQL,
    }
