"""Structured Streaming twins of the freshness, dedup and seen-set operators."""
