"""Readers, writers, lookup tables and model bundles."""
