"""Corpus-scale jobs that turn page text into structured knowledge, as DataFrame → DataFrame functions."""
