"""Incremental runs over a stream of chunk files."""
