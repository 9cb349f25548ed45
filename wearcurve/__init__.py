"""Predictive-maintenance analytics for fleets of machines, written as Spark DataFrame jobs."""

from wearcurve.layout import CONTIGUOUS, Layout

__all__ = ["CONTIGUOUS", "Layout"]
