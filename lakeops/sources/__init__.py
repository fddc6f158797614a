"""Readers, sinks and versioned datasets."""
