"""The corpus pipeline by the name that drivers look for; its stages are in ``meadowlark/llm/pipeline.py``."""

from __future__ import annotations

from meadowlark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
