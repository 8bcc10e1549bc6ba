"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

from pressgauge.llm import (
    decontaminate, extraction, fill_middle, fingerprints, jaccard_join, licenses, mixing, pii, preference, toxicity,
    url_filter, variants, warc,
)

QUERIES = {
    "op1_decontaminate": (decontaminate.query, None),
    "op2_toxicity": (toxicity.query, None),
    "op3_jaccard_join": (jaccard_join.query, None),
    "op4_license_scan": (licenses.query, None),
    "op5_pii": (pii.query, None),
    "op6_url_filter": (url_filter.query, url_filter.SQL),
    "op7_fingerprints": (fingerprints.query, None),
    "op8_warc": (warc.query, warc.SQL),
    "op9_preference": (preference.query, preference.SQL),
    "op10_mixing": (mixing.query, mixing.SQL),
    "op11_fill_middle": (fill_middle.query, fill_middle.SQL),
    "op12_variants": (variants.query, None),
    "op13_extraction": (extraction.query, None),
}
