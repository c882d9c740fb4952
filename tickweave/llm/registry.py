"""Registered queries of the training-data operators and their DuckDB SQL."""
from __future__ import annotations

from . import (alignment, decontaminate, langid, licenses, packing, quality, quotes, ranked, simhash, tokencount,
               topk, toxicity, wrappers)

QUERIES = {
    "op1_quotation_linking": quotes.op1_quotation_linking,
    "op2_winnowing": decontaminate.op2_winnowing,
    "op3_generalised_pigeonhole": simhash.op3_generalised_pigeonhole,
    "op4_sum_of_squares_packing": packing.op4_sum_of_squares_packing,
    "op5_union_free_wrappers": wrappers.op5_union_free_wrappers,
    "op6_importance_resampling": quality.op6_importance_resampling,
    "op7_columnar_branch_and_bound": topk.op7_columnar_branch_and_bound,
    "op8_trie_unigram_counts": tokencount.op8_trie_unigram_counts,
    "op9_kneser_ney_language_id": langid.op9_kneser_ney_language_id,
    "op10_naive_bayes_toxicity": toxicity.op10_naive_bayes_toxicity,
    "op11_ordered_signature_rules": licenses.op11_ordered_signature_rules,
    "op12_perfect_hash_alignment": alignment.op12_perfect_hash_alignment,
    "op13_best_position_search": ranked.op13_best_position_search,
}
SQL = {
    "op1_quotation_linking": quotes.OP1_SQL,
    "op2_winnowing": decontaminate.OP2_SQL,
    "op7_columnar_branch_and_bound": topk.OP7_SQL,
    "op11_ordered_signature_rules": licenses.OP11_SQL,
    "op13_best_position_search": ranked.OP13_SQL,
}
