"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from dayshape.llm.decontaminate import op2
from dayshape.llm.language_id import op13
from dayshape.llm.lexical_search import ORACLE as LEXICAL
from dayshape.llm.lexical_search import op12
from dayshape.llm.license_scan import op7
from dayshape.llm.lines import op1
from dayshape.llm.manifest import ORACLE as MANIFEST
from dayshape.llm.manifest import op11
from dayshape.llm.mixing_model import op4
from dayshape.llm.near_copies import op3
from dayshape.llm.packing import op6
from dayshape.llm.substrings import op8
from dayshape.llm.token_counts import op10
from dayshape.llm.top_products import ORACLE as TOP_PRODUCTS
from dayshape.llm.top_products import op9
from dayshape.llm.toxicity import op5

QUERIES = {
    "op1_line_dedup": op1,
    "op2_benchmark_decontamination": op2,
    "op3_minhash_near_dedup": op3,
    "op4_mixing_scores": op4,
    "op5_toxicity": op5,
    "op6_best_fit_packing": op6,
    "op7_license_scan": op7,
    "op8_substring_dedup": op8,
    "op9_exact_top_products": op9,
    "op10_token_counts": op10,
    "op11_merkle_manifest": op11,
    "op12_ranked_search": op12,
    "op13_language_id": op13,
}

ORACLES: dict[str, str] = {
    "op9_exact_top_products": TOP_PRODUCTS,
    "op11_merkle_manifest": MANIFEST,
    "op12_ranked_search": LEXICAL,
}
