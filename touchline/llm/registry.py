"""The registered queries of the training-data operators."""

from __future__ import annotations

from touchline.llm import (
    alignment,
    licences,
    lines,
    mixing,
    near_duplicates,
    nearest,
    packing,
    quality,
    repeats,
    sharding,
    spelling,
    tokens,
    toxicity,
)
from touchline.llm.oracles import ORACLES
from touchline.llm.shipping import with_package

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    f.__name__: with_package(f)
    for f in (
        sharding.op1_rendezvous_sharding,
        mixing.op2_hash_threshold_mix,
        near_duplicates.op3_setsketch_near_duplicates,
        tokens.op4_offset_attribution,
        lines.op5_line_frequency,
        repeats.op6_common_prefix_intervals,
        licences.op7_licence_digests,
        toxicity.op8_compression_distance,
        nearest.op9_block_matrix_search,
        packing.op10_best_fit_packing,
        alignment.op11_token_alignment,
        quality.op12_byte_network,
        spelling.op13_permuterm_variants,
    )
}
