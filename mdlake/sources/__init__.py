"""Catalog readers and the market tables derived from the driver's tables."""
