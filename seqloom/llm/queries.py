"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from seqloom.llm import licence_digests, mixing, target_resampling, tree_negatives
from seqloom.llm.crf_toxicity import op9_crf_toxicity
from seqloom.llm.hilbert_shards import op1_hilbert_shards
from seqloom.llm.jpeg_media import op10_jpeg_media
from seqloom.llm.licence_digests import op6_licence_digests
from seqloom.llm.line_blocks import op3_line_blocks
from seqloom.llm.mixing import op4_source_mixing
from seqloom.llm.simhash_segments import op7_simhash_segments
from seqloom.llm.srs_neighbours import op5_srs_neighbours
from seqloom.llm.suffix_repeats import op11_suffix_repeats
from seqloom.llm.swap_packing import op8_swap_packing
from seqloom.llm.target_resampling import op13_target_resampling
from seqloom.llm.tree_negatives import op12_tree_negatives
from seqloom.llm.url_markov import op2_url_markov

QUERIES = {
    f.__name__: f
    for f in (
        op1_hilbert_shards,
        op2_url_markov,
        op3_line_blocks,
        op4_source_mixing,
        op5_srs_neighbours,
        op6_licence_digests,
        op7_simhash_segments,
        op8_swap_packing,
        op9_crf_toxicity,
        op10_jpeg_media,
        op11_suffix_repeats,
        op12_tree_negatives,
        op13_target_resampling,
    )
}

ORACLES = {"op4_source_mixing": mixing.SQL, "op6_licence_digests": licence_digests.sql(), "op12_tree_negatives": tree_negatives.SQL, "op13_target_resampling": target_resampling.SQL}
