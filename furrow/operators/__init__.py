"""Joins, aggregates, windows, raster and clustering operators."""
