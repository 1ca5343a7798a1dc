"""The two registries side by side."""

from __future__ import annotations

from delaynet.plans.oracles import ORACLES
from delaynet.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
