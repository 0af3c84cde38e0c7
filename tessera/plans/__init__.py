"""Registered queries over the driver tables: each key pairs a Spark plan with
an independent SQL statement of the same result (when SQL can express it)."""

from .registry import REGISTRY, oracle_sql, queries  # noqa: F401
from . import (q_stats, q_math, q_text, q_chunk, q_embed, q_state, q_files,  # noqa: F401
               q_language, q_telemetry, q_formats, q_listing, q_docx, q_streams, q_channels)
