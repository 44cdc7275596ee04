"""All registered queries."""

from waferline.plans import features, monitor, rules, scans, sources, streams, values, wide  # noqa: F401
from waferline.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
