"""Operators of each layer: contract, provenance, bronze, history, quality,
silver, dims, grid, gold, reconcile and skew."""
