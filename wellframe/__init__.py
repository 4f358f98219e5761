"""Groundwater analytics on Spark: harmonisation, per-well products and data-quality operators."""

__version__ = "0.1.0"
