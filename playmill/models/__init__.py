"""The catalogue of models: functions from named tables to named tables, built on the operators."""

from __future__ import annotations

from . import analyses, events, expectancy, games, learning, metric_tables, rollups, seasons, staging, states  # noqa: F401
from .catalogue import MODELS, Catalogue
from .store import Store, build

__all__ = ["MODELS", "Catalogue", "Store", "build"]
