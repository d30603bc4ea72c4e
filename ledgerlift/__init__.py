"""Spark jobs that reshape purchasing, stock, fleet and asset records."""

from ledgerlift.params import RunParams

__all__ = ["RunParams"]
