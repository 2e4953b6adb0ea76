"""Flat files, published tabs and the envelope store."""
