"""Event and line-data operators for PySpark, usable on tables and on streams."""

from eventloom.session import build_session, drop_scratch, scratch_path, stage_table

__all__ = ["build_session", "drop_scratch", "scratch_path", "stage_table"]
