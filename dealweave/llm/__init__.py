"""Operators of a training-data pipeline. Nothing outside this package imports it but the driver contract."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
