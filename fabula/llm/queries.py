"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from fabula.llm.chunk_dedup import op8_chunk_dedup
from fabula.llm.ivf_pq import op10_ivf_pq
from fabula.llm.mjpeg import op9_mjpeg
from fabula.llm.ngram_jaccard import op2_ngram_jaccard
from fabula.llm.quality import op1_quality
from fabula.llm.suffix_dedup import op5_suffix_dedup
from fabula.llm import temperature
from fabula.llm.temperature import op7_temperature_mixing
from fabula.llm.toxicity import op4_toxicity
from fabula.llm.trie_bpe import op6_trie_bpe
from fabula.llm.wrappers import op3_wrappers

QUERIES = {f.__name__: f for f in (op1_quality, op2_ngram_jaccard, op3_wrappers, op4_toxicity, op5_suffix_dedup, op6_trie_bpe, op7_temperature_mixing, op8_chunk_dedup, op9_mjpeg, op10_ivf_pq)}

ORACLE_SQL: dict[str, str] = {"op7_temperature_mixing": temperature.ORACLE}
