"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationlake.llm import (
    bpe, decontam, fim, html_text, iblt, langid, lines, resample, simhash, tokens, toxicity, urlfilter, warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_token_output": tokens.op2_token_output,
        "op3_fingerprints": iblt.op3_fingerprints,
        "op4_line_dedup": lines.op4_line_dedup,
        "op5_language": langid.op5_language,
        "op6_bpe": bpe.op6_bpe,
        "op7_html_text": html_text.op7_html_text,
        "op8_decontaminate": decontam.op8_decontaminate,
        "op9_url_filter": urlfilter.op9_url_filter,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_fill_in_middle": fim.op11_fill_in_middle,
        "op12_warc": warc.op12_warc,
        "op13_importance_resampling": resample.op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": lines.OP4_SQL,
        "op11_fill_in_middle": fim.OP11_SQL,
        "op12_warc": warc.OP12_SQL,
        "op13_importance_resampling": resample.OP13_SQL,
    }
