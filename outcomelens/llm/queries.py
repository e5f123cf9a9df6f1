"""Loads the modules that register the corpus queries."""

from outcomelens.llm import automaton_dedup, bpe_heap, dac_tokens, es_mixing, fertility, gain_resample, merkle_manifest, simhash_ball, suffix_decontam, text_density, viterbi_langid, warc_zip, zstd_quality  # noqa: F401
from outcomelens.llm.common import QUERIES, SQL  # noqa: F401
