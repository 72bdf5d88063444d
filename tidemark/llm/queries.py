"""Registry of the corpus queries: opN_<name>, with DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .huffman import op7_huffman_ids
from .hyperlang import op8_hyperdimensional_langid
from .license_rules import OP5_SQL, op5_license_rules
from .line_spread import OP6_SQL, op6_line_spread
from .lsh_forest import op2_minhash_forest
from .page_wrapper import op4_page_wrapper
from .phrase_index import op9_phrase_index
from .piece_lattice import op10_piece_lattice
from .preference_chat import OP1_SQL, op1_preference_chat
from .robust_quality import op3_robust_quality

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_preference_chat": op1_preference_chat,
    "op2_minhash_forest": op2_minhash_forest,
    "op3_robust_quality": op3_robust_quality,
    "op4_page_wrapper": op4_page_wrapper,
    "op5_license_rules": op5_license_rules,
    "op6_line_spread": op6_line_spread,
    "op7_huffman_ids": op7_huffman_ids,
    "op8_hyperdimensional_langid": op8_hyperdimensional_langid,
    "op9_phrase_index": op9_phrase_index,
    "op10_piece_lattice": op10_piece_lattice,
}
ORACLE_SQL: dict[str, str] = {
    "op1_preference_chat": OP1_SQL,
    "op5_license_rules": OP5_SQL,
    "op6_line_spread": OP6_SQL,
}
