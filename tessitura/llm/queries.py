"""Registered queries of the corpus operators and their SQL texts."""

from __future__ import annotations

from .decontam import op7_decontamination
from .exact import OP8_SQL, op8_exact_dedup
from .licenses import OP4_SQL, op4_licenses
from .manifest_tree import OP13_SQL, op13_merkle
from .packing import op11_packing
from .pieces import op3_pieces
from .quality import op9_quality
from .secrets import op10_secrets
from .sharding import op2_sharding
from .simhash import op6_simhash
from .token_files import op5_token_files
from .toxicity import op1_toxicity
from .whitening import op12_whitening

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_pieces": op3_pieces,
    "op4_licenses": op4_licenses,
    "op5_token_files": op5_token_files,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_secrets": op10_secrets,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_merkle": op13_merkle,
}
SQL = {"op4_licenses": OP4_SQL, "op8_exact_dedup": OP8_SQL, "op13_merkle": OP13_SQL}
