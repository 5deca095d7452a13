"""The queries of this folder and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmargin.llm.collocations import OP11_SQL, op11_multikey_collocations
from gridmargin.llm.graph import op6_pruned_graph
from gridmargin.llm.hyperminhash import OP13_SQL, op13_hyperminhash
from gridmargin.llm.lm_scoring import op10_gated_recurrent
from gridmargin.llm.mixing import op4_raked_mixture
from gridmargin.llm.packing import op7_pack_power_of_two
from gridmargin.llm.quality import op1_bradley_terry
from gridmargin.llm.ranked_search import OP12_SQL, op12_range_maximum_search
from gridmargin.llm.rules import OP9_SQL, op9_risk_controlled_rules
from gridmargin.llm.simhash import op3_simhash_ball
from gridmargin.llm.style_tree import op2_site_style_tree
from gridmargin.llm.suffixes import op8_suffix_intervals
from gridmargin.llm.superkmers import op5_super_kmers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bradley_terry": op1_bradley_terry,
    "op2_site_style_tree": op2_site_style_tree,
    "op3_simhash_ball": op3_simhash_ball,
    "op4_raked_mixture": op4_raked_mixture,
    "op5_super_kmers": op5_super_kmers,
    "op6_pruned_graph": op6_pruned_graph,
    "op7_pack_power_of_two": op7_pack_power_of_two,
    "op8_suffix_intervals": op8_suffix_intervals,
    "op9_risk_controlled_rules": op9_risk_controlled_rules,
    "op10_gated_recurrent": op10_gated_recurrent,
    "op11_multikey_collocations": op11_multikey_collocations,
    "op12_range_maximum_search": op12_range_maximum_search,
    "op13_hyperminhash": op13_hyperminhash,
}
ORACLE: dict[str, str] = {
    "op9_risk_controlled_rules": OP9_SQL,
    "op11_multikey_collocations": OP11_SQL,
    "op12_range_maximum_search": OP12_SQL,
    "op13_hyperminhash": OP13_SQL,
}
