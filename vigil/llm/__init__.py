"""Operators of a training-data pipeline (privacy, deduplication, filters,
formatting, scoring, tokenising), each one module. Nothing else in the library
imports this subpackage."""
