"""Readers for files and streams, and the parsing of raw records."""
