"""Equivalent SQL for every registered query."""

from parcelflow.oracles.queries import ORACLES

__all__ = ["ORACLES"]
