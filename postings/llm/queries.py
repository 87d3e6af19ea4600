"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat import OP4_SQL, op4_chat_examples
from .decontaminate import OP2_SQL, op2_decontaminate
from .fill_in_middle import OP12_SQL, op12_fill_in_middle
from .fingerprints import op3_fingerprints
from .jaccard_join import op10_jaccard_join
from .kd_shards import op9_kd_shards
from .line_dedup import op5_line_dedup
from .quality_rules import OP11_SQL, op11_quality_rules
from .sentencepieces import op6_sampled_pieces
from .suffix_dedup import op1_suffix_dedup
from .suffix_tree_lm import op8_suffix_tree_lm
from .token_alignment import op13_token_alignment
from .toxicity import op7_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_fingerprints": op3_fingerprints,
    "op4_chat_examples": op4_chat_examples,
    "op5_line_dedup": op5_line_dedup,
    "op6_sampled_pieces": op6_sampled_pieces,
    "op7_toxicity": op7_toxicity,
    "op8_suffix_tree_lm": op8_suffix_tree_lm,
    "op9_kd_shards": op9_kd_shards,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_quality_rules": op11_quality_rules,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op2_decontaminate": OP2_SQL,
    "op4_chat_examples": OP4_SQL,
    "op11_quality_rules": OP11_SQL,
    "op12_fill_in_middle": OP12_SQL,
}
