"""Tuned regressors on panels: fitting, search, validation and comparison."""
