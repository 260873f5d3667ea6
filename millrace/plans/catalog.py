"""All registered queries; importing a plan module registers its queries."""

from millrace.plans import corpus, joining, learning, moving, profiling, rates, stats, trading, windowing  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
