"""Operators for preparing training corpora: identification, deduplication, decontamination, mixing, formatting."""
