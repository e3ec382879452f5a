"""The queries of this subpackage, by name. SQL is given where it can express a query."""

from __future__ import annotations

from fragloom.llm.byte_bpe import op7_byte_bpe
from fragloom.llm.chat import op6_prefix_target_chat
from fragloom.llm.de_bruijn import op4_de_bruijn_dedup
from fragloom.llm.decontaminate import op2_wu_manber_decontamination
from fragloom.llm.fingerprints import op1_chunk_fingerprints
from fragloom.llm.line_rules import op11_line_first_rules
from fragloom.llm.manifest import op12_slot_pivot_manifest
from fragloom.llm.oracles import ORACLES
from fragloom.llm.prefix_trie import op13_prefix_trie
from fragloom.llm.quality import op3_fourier_quality
from fragloom.llm.sharding import op10_histogram_sort_shards
from fragloom.llm.simhash import op5_multi_index_simhash
from fragloom.llm.suffix_array import op8_suffix_array_dedup
from fragloom.llm.warc import op9_salvaged_warc

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_chunk_fingerprints": op1_chunk_fingerprints,
    "op2_wu_manber_decontamination": op2_wu_manber_decontamination,
    "op3_fourier_quality": op3_fourier_quality,
    "op4_de_bruijn_dedup": op4_de_bruijn_dedup,
    "op5_multi_index_simhash": op5_multi_index_simhash,
    "op6_prefix_target_chat": op6_prefix_target_chat,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_salvaged_warc": op9_salvaged_warc,
    "op10_histogram_sort_shards": op10_histogram_sort_shards,
    "op11_line_first_rules": op11_line_first_rules,
    "op12_slot_pivot_manifest": op12_slot_pivot_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
