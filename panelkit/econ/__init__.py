"""Dynamic panel estimation with two-way fixed effects, and its diagnostics."""
