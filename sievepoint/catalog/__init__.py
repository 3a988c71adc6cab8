"""Registered queries, each with the SQL that checks it where SQL can say the same."""

from sievepoint.catalog.registry import ORACLES, QUERIES
from sievepoint.catalog import (cleaning, encoders, evaluation, logs, modelling, partitions,  # noqa: F401
                                quality, screening)

__all__ = ["ORACLES", "QUERIES"]
