"""Named queries over the source tables."""

from . import cash, evaluation, foundation, indicators, loop, models, monitoring, papers, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
