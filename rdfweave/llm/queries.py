"""Registered queries of this folder, and SQL for those that it can express."""

from __future__ import annotations

from rdfweave.llm.html import op4_tree_model
from rdfweave.llm.merkle import OP13_SQL, op13_slot_pivot
from rdfweave.llm.minhash import op7_bbit_minhash
from rdfweave.llm.packing import op8_best_fit
from rdfweave.llm.pii import op2_disclosure
from rdfweave.llm.quality import op5_quality_trees
from rdfweave.llm.resampling import OP12_SQL, op12_segment_resampling
from rdfweave.llm.rules import OP9_SQL, op9_host_rules
from rdfweave.llm.secrets import op11_decoding_worklist
from rdfweave.llm.suffix import op1_induced_sorting
from rdfweave.llm.tiling import op6_string_tiling
from rdfweave.llm.tokenfile import op3_range_coder
from rdfweave.llm.toxicity import op10_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_induced_sorting, op2_disclosure, op3_range_coder, op4_tree_model, op5_quality_trees,
        op6_string_tiling, op7_bbit_minhash, op8_best_fit, op9_host_rules, op10_toxicity,
        op11_decoding_worklist, op12_segment_resampling, op13_slot_pivot,
    )
}
ORACLES = {"op9_host_rules": OP9_SQL, "op12_segment_resampling": OP12_SQL, "op13_slot_pivot": OP13_SQL}
