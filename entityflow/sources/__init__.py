"""Readers and page extractors."""
