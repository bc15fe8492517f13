"""Readers and writers: CSV extracts, landing manifests, staged tables."""
