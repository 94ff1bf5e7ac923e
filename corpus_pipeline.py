"""A training corpus from `documents`: STAGES, run(spark, sf_dir) over them, and ORACLE_SQL (see eventmart/llm/pipeline.py)."""

from eventmart.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
