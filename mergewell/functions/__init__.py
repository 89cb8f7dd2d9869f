"""Column functions: normalisation, similarity, n-gram weights and pair features."""
