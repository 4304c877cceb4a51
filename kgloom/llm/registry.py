"""Queries of this subpackage, and their results in DuckDB SQL where SQL can express them."""

from __future__ import annotations

from .bpe import op8_bpe_round_trip
from .chat import OP4_SQL, op4_chat_format
from .fingerprints import op6_quartile_digest
from .langid import op5_language_id
from .line_rules import OP9_SQL, op9_line_frequency_rules
from .merkle import OP11_SQL, op11_merkle_manifest
from .packing import op10_concatenate_and_cut
from .sharding import OP13_SQL, op13_kd_tree_shards
from .simhash import op3_simhash_groups
from .substring import OP1_SQL, op1_recompression
from .toxicity import op2_toxicity
from .warc_zip import OP7_SQL, op7_warc_zip
from .whitening import op12_embedding_whitening

QUERIES = {
    "op1_recompression": op1_recompression,
    "op2_toxicity": op2_toxicity,
    "op3_simhash_groups": op3_simhash_groups,
    "op4_chat_format": op4_chat_format,
    "op5_language_id": op5_language_id,
    "op6_quartile_digest": op6_quartile_digest,
    "op7_warc_zip": op7_warc_zip,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_line_frequency_rules": op9_line_frequency_rules,
    "op10_concatenate_and_cut": op10_concatenate_and_cut,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_kd_tree_shards": op13_kd_tree_shards,
}

ORACLES = {
    "op1_recompression": OP1_SQL,
    "op4_chat_format": OP4_SQL,
    "op7_warc_zip": OP7_SQL,
    "op9_line_frequency_rules": OP9_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op13_kd_tree_shards": OP13_SQL,
}
