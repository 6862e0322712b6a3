"""Readers, writers and the views over the order tables."""
