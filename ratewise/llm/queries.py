"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import OP9_SQL, op9_chat_formatting
from .decontam import OP1_SQL, op1_decontamination
from .embeddings import OP5_SQL, op5_embedding_dedup
from .html import op10_html_extraction
from .langid import op8_language_id
from .lines import OP3_SQL, op3_line_dedup
from .minhash import OP4_SQL, op4_minhash_dedup
from .packing import op6_best_fit_packing
from .quality import op7_quality_classifier
from .repair import OP12_SQL, op12_conversation_repair
from .spelling import OP11_SQL, op11_spelling_variants
from .tokens import op2_token_counts
from .urls import OP13_SQL, op13_url_filters

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_line_dedup": op3_line_dedup,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_language_id": op8_language_id,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_html_extraction": op10_html_extraction,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_url_filters": op13_url_filters,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op3_line_dedup": OP3_SQL,
    "op4_minhash_dedup": OP4_SQL,
    "op5_embedding_dedup": OP5_SQL,
    "op9_chat_formatting": OP9_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_url_filters": OP13_SQL,
}
