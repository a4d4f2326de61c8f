"""Registered queries of the numbered operators, and their DuckDB oracles."""

from __future__ import annotations

from quantspark.llm import (bpe, codes, fingerprints, licenses, mixing, secrets, sharding, simhash, tokenfiles, topk, toxicity, urls,
                            whitening)

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_licenses": licenses.op2_licenses,
    "op3_token_counts": tokenfiles.op3_token_counts,
    "op4_bpe": bpe.op4_bpe,
    "op5_mixing": mixing.op5_mixing,
    "op6_sharding": sharding.op6_sharding,
    "op7_topk": topk.op7_topk,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_simhash": simhash.op9_simhash,
    "op10_secrets": secrets.op10_secrets,
    "op11_vector_codes": codes.op11_vector_codes,
    "op12_url_filters": urls.op12_url_filters,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE: dict[str, str] = {
    "op6_sharding": sharding.oracle(),
    "op7_topk": topk.ORACLE,
    "op11_vector_codes": codes.ORACLE,
    "op12_url_filters": urls.ORACLE,
}
