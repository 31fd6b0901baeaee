"""Readers, writers and the adapter from the benchmark tables."""
