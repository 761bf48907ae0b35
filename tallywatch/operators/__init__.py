"""Batch operators on transaction tables."""
