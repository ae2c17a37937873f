"""Readers, writers and the catalogue of the driver's test tables."""
