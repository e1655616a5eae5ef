"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .ann import OP1_SQL, op1_ann
from .lexical_search import OP12_SQL, op12_lexical_search
from .license_scan import op5_license_scan
from .line_dedup import OP2_SQL, op2_line_dedup
from .minhash_dedup import op9_minhash_dedup
from .mixing import op7_source_mixing
from .packing import op6_best_fit_packing
from .quality_model import op3_quality_model
from .quality_rules import op4_quality_rules
from .substring_dedup import op10_substring_dedup
from .token_alignment import op11_token_alignment
from .token_counts import op13_token_counts
from .warc import OP8_SQL, op8_warc

QUERIES = {
    "op1_ann": op1_ann,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_model": op3_quality_model,
    "op4_quality_rules": op4_quality_rules,
    "op5_license_scan": op5_license_scan,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_source_mixing": op7_source_mixing,
    "op8_warc": op8_warc,
    "op10_substring_dedup": op10_substring_dedup,
    "op9_minhash_dedup": op9_minhash_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_counts": op13_token_counts,
}

SQL: dict[str, str] = {
    "op1_ann": OP1_SQL,
    "op2_line_dedup": OP2_SQL,
    "op8_warc": OP8_SQL,
    "op12_lexical_search": OP12_SQL,
}
