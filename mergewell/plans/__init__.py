"""Whole plans: name lookup, the linking model, and the pipeline from sources to audited results."""
