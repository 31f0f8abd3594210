"""The queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from monthlake.llm import (
    embedding_dedup,
    language_id,
    license_scan,
    minhash,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
    url_filter,
    vector_codes,
    whitening,
)
from monthlake.llm import text as tx


def _configured(fn):
    return lambda spark, sf_dir: fn(tx.settings(spark), sf_dir)


_ALL = [
    quality_classifier.op1_quality_classifier,
    quality_rules.op2_quality_rules,
    language_id.op3_language_id,
    mixing.op4_source_mix,
    embedding_dedup.op5_embedding_dedup,
    suffix_dedup.op6_suffix_dedup,
    minhash.op7_minhash_dedup,
    packing.op8_best_fit_packing,
    license_scan.op9_license_scan,
    url_filter.op10_url_filter,
    whitening.op11_embedding_whitening,
    toxicity.op12_toxicity,
    vector_codes.op13_vector_codes,
]

QUERIES = {fn.__name__: _configured(fn) for fn in _ALL}
SQL = {
    "op2_quality_rules": quality_rules.OP2_SQL,
    "op4_source_mix": mixing.OP4_SQL,
    "op9_license_scan": license_scan.OP9_SQL,
    "op10_url_filter": url_filter.OP10_SQL,
    "op13_vector_codes": vector_codes.OP13_SQL,
}
