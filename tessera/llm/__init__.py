"""Operators of a training-data pipeline. Nothing outside this package imports it."""

from .registry import oracle_sql, queries  # noqa: F401
from . import (  # noqa: F401
    q_decontaminate, q_fim, q_importance, q_language, q_licenses, q_lines, q_mix, q_near, q_quality, q_repeats, q_rollup, q_tokens, q_warc)
