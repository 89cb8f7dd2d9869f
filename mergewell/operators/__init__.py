"""Blocking, candidate ranking, evaluation and audit operators: tables in, tables out."""
