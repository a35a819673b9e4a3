"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, language, licenses, maxscore, mixing, nearest, neardup, packing, spelling, substrings, toxicity, tries, urls

QUERIES = {
    "op1_prefix_target_chat": chat.query,
    "op2_url_boosted_trees": urls.query,
    "op3_collision_counting": nearest.query,
    "op4_lsh_forest": neardup.query,
    "op5_text_cnn": toxicity.query,
    "op6_string_kernel": language.query,
    "op7_maxscore": maxscore.query,
    "op8_suffix_automata": substrings.query,
    "op9_vector_best_fit": packing.query,
    "op10_mix_sources": mixing.query,
    "op11_trie_node_pairs": spelling.query,
    "op12_burst_tries": tries.query,
    "op13_diagonal_voting": licenses.query,
}
SQL = {"op1_prefix_target_chat": chat.SQL, "op4_lsh_forest": neardup.SQL, "op7_maxscore": maxscore.SQL, "op8_suffix_automata": substrings.SQL, "op10_mix_sources": mixing.SQL, "op11_trie_node_pairs": spelling.SQL, "op12_burst_tries": tries.SQL, "op13_diagonal_voting": licenses.SQL}
