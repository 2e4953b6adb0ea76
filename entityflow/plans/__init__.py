"""Whole record-type plans and the full run."""
