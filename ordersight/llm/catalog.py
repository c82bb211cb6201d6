"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from ordersight.llm.capture_index import op12_capture_index
from ordersight.llm.decontamination import op7_decontamination
from ordersight.llm.embedding_links import op8_embedding_links
from ordersight.llm.expected_sql import EXPECTED_SQL
from ordersight.llm.language_id import op9_language
from ordersight.llm.near_duplicates import op6_near_duplicates
from ordersight.llm.packing import op10_packing
from ordersight.llm.quality_model import op2_quality
from ordersight.llm.repeats import op4_suffix_repeats
from ordersight.llm.sharding import op5_sharding
from ordersight.llm.source_divergence import op11_source_divergence
from ordersight.llm.spelling_variants import op13_spelling_variants
from ordersight.llm.token_counts import op3_token_counts
from ordersight.llm.toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_token_counts": op3_token_counts,
    "op4_suffix_repeats": op4_suffix_repeats,
    "op5_sharding": op5_sharding,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_decontamination": op7_decontamination,
    "op8_embedding_links": op8_embedding_links,
    "op9_language": op9_language,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_capture_index": op12_capture_index,
    "op13_spelling_variants": op13_spelling_variants,
}

__all__ = ["EXPECTED_SQL", "QUERIES"]
