"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pitchline.llm.bit_packing import op4_bit_packing
from pitchline.llm.hard_negatives import op12_hard_negatives
from pitchline.llm.hilbert_neighbours import op9_hilbert_neighbours
from pitchline.llm.host_quality import op8_host_quality
from pitchline.llm.licenses import op6_license_scan
from pitchline.llm.oracle import ORACLE  # noqa: F401
from pitchline.llm.order_minhash import op3_order_minhash
from pitchline.llm.pfair import op10_mix_sources
from pitchline.llm.ppm import op2_ppm_score
from pitchline.llm.prefix_tree import op13_prefix_trie
from pitchline.llm.repeats import op7_maximal_repeats
from pitchline.llm.secrets import op1_secret_scan
from pitchline.llm.sentencepiece_backend import op5_sentencepiece
from pitchline.llm.simhash_join import op11_simhash_join


def pipeline(spark, sf_dir):
    """The corpus pipeline of the repository's top folder, all stages."""
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {q.__name__: q for q in (
    op1_secret_scan, op2_ppm_score, op3_order_minhash, op4_bit_packing, op5_sentencepiece, op6_license_scan,
    op7_maximal_repeats, op8_host_quality, op9_hilbert_neighbours, op10_mix_sources,
    op11_simhash_join, op12_hard_negatives, op13_prefix_trie, pipeline)}
