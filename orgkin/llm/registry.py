"""The corpus queries, each over a whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from orgkin.llm import (
    byte_bpe, centroids, collocations, html_text, jaccard_join, mixing, pii, posting_lists, quality_classifier,
    quality_rules, sentence_spans, toxicity, warc,
)

QUERIES = {
    "op1_byte_bpe": byte_bpe.query,
    "op2_posting_lists": posting_lists.query,
    "op3_toxicity": toxicity.query,
    "op4_sentence_spans": sentence_spans.query,
    "op5_html_text": html_text.query,
    "op6_quality_classifier": quality_classifier.query,
    "op7_pii_surrogates": pii.query,
    "op8_jaccard_join": jaccard_join.query,
    "op9_quality_rules": quality_rules.query,
    "op10_source_mixing": mixing.query,
    "op11_collocations": collocations.query,
    "op12_centroids": centroids.query,
    "op13_warc_bundles": warc.query,
}
ORACLES = {
    "op10_source_mixing": mixing.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_centroids": centroids.ORACLE,
    "op13_warc_bundles": warc.ORACLE,
}
