"""Registration of the queries of this subpackage."""

from __future__ import annotations

import importlib

from qloom.plans.registry import Query

MODULES = "decontamination line_dedup simhash archives token_records packing quality_rules toxicity resampling html_text lloyd whitening chosen_path".split()

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

for _name in MODULES:
    _module = importlib.import_module(f"qloom.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(getattr(_module, "ORACLES", {}))
