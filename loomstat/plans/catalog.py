"""All registered queries; importing the modules fills the registry."""

from loomstat.plans import learners, pairs, regression, scoring, tabular, text  # noqa: F401
from loomstat.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
