"""Imports the operators' modules, which register their queries."""

from __future__ import annotations

import importlib

MODULES = (
    "packing", "outliers", "sharding", "tag_paths", "substring_dedup", "language_id", "lm_scoring",
    "exact_dedup", "near_dedup", "byte_bpe", "resampling", "hard_negatives", "chat",
)

for _name in MODULES:
    importlib.import_module(f"ledgerloom.llm.{_name}")
