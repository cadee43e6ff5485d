"""Column-level functions: labels, guarded arithmetic, tail probabilities."""
