"""The registered queries of the text operators, and their SQL where DuckDB can express them."""

from __future__ import annotations

from importlib import import_module

from . import exact_dedup, ngram_join
from .common import table


def _of(module: str, function: str, name: str = "documents"):
    def query(spark, sf_dir):
        return getattr(import_module(f"{__package__}.{module}"), function)(table(spark, sf_dir, name))

    return query


QUERIES = {
    "op1_language_id": _of("language_id", "language_predictions"),
    "op2_substring_dedup": _of("substring_dedup", "substring_dedup_report"),
    "op3_lm_scoring": _of("lm_scoring", "lm_scores"),
    "op4_fingerprints": _of("fingerprints", "fingerprint_report"),
    "op5_ngram_jaccard_join": _of("ngram_join", "ngram_components"),
    "op6_best_fit_packing": _of("packing", "packed_pieces"),
    "op7_exact_dedup": _of("exact_dedup", "exact_duplicates_report"),
    "op8_token_counts": _of("token_counts", "token_counts"),
    "op9_byte_bpe": _of("byte_bpe", "encode_decode_digests"),
    "op10_html_extraction": _of("html_wrappers", "main_texts", "pages"),
}

ORACLE_SQL: dict[str, str] = {"op5_ngram_jaccard_join": ngram_join.SQL, "op7_exact_dedup": exact_dedup.SQL}
