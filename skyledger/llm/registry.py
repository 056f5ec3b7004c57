"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from ..session import ensure_conf
from . import (bpe, exact_dedup, fingerprints, html_extract, language_id, mixing, near_dedup,
               phrases, secrets, toxicity, url_filters, vector_codes, warc)

_OPERATORS = (
    bpe.op1_bpe, secrets.op2_secrets, fingerprints.op3_fingerprints,
    exact_dedup.op4_exact_dedup, url_filters.op5_url_filters, html_extract.op6_html_text,
    near_dedup.op7_near_dedup, mixing.op8_mix_sources, warc.op9_warc,
    language_id.op10_language_id, language_id.page_languages,
    toxicity.op11_toxicity, vector_codes.op12_vector_codes, phrases.op13_phrases,
)


def _query(fn):
    def run(spark, sf_dir):
        return fn(ensure_conf(spark), sf_dir)
    run.__name__ = fn.__name__
    return run


QUERIES = {fn.__name__: _query(fn) for fn in _OPERATORS}
ORACLE: dict[str, str] = {"op4_exact_dedup": exact_dedup.ORACLE,
                          "op5_url_filters": url_filters.ORACLE,
                          "op7_near_dedup": near_dedup.ORACLE,
                          "op9_warc": warc.ORACLE,
                          "op12_vector_codes": vector_codes.ORACLE,
                          "op13_phrases": phrases.ORACLE}
