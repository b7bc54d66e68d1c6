"""The corpus pipeline: documents to token ids in five stages, kept in broadleaf.llm.pipeline."""

from broadleaf.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
