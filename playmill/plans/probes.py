"""All registered queries of the library, one or more per operator."""

from __future__ import annotations

from . import probes_basic, probes_functions, probes_groups, probes_jobs, probes_models, probes_pipelines, probes_windows  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
