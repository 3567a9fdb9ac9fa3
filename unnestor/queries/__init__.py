"""Catalogue queries over documents derived from the driver tables."""
