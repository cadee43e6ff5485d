"""Readers, writers, lookup tables and panels derived from fact tables."""
