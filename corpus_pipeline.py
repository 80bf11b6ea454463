"""The document pipeline; its stages are in ``dinerlake.llm.pipeline``."""

from dinerlake.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
