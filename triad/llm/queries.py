"""Registered queries of the subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from triad.llm import credentials, licenses
from triad.llm.chat import op8_role_repair
from triad.llm.credentials import op13_secret_ownership
from triad.llm.html import op9_text_density
from triad.llm.language import op6_bitsliced_langid
from triad.llm.leaks import op4_string_tiling
from triad.llm.near import op10_odd_sketch_dedup
from triad.llm.pii import op5_bootstrapped_pii
from triad.llm.quality import op2_mcd_outliers
from triad.llm.runs import op12_periodic_runs
from triad.llm.scoring import OP1_SQL, op1_cross_entropy_difference
from triad.llm.segment import op7_gumbel_topk
from triad.llm.trie import OP11_SQL, op11_prefix_trie

QUERIES = {f.__name__: f for f in (
    op1_cross_entropy_difference, op2_mcd_outliers, licenses.op3_license_sentences, op4_string_tiling,
    op5_bootstrapped_pii, op6_bitsliced_langid, op7_gumbel_topk, op8_role_repair, op9_text_density,
    op10_odd_sketch_dedup, op11_prefix_trie, op12_periodic_runs, op13_secret_ownership)}

#: The others iterate, tile, sample or parse; they are tested against brute force.
ORACLE = {"op1_cross_entropy_difference": OP1_SQL, "op3_license_sentences": licenses.oracle(),
          "op11_prefix_trie": OP11_SQL, "op13_secret_ownership": credentials.oracle()}
