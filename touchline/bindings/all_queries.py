"""Importing this module registers every query."""

from touchline.bindings import files, league, marts, pipeline, players, quality  # noqa: F401
from touchline.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
