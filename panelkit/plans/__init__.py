"""Whole jobs: preparing a panel, and the catalogue of named queries."""
