"""Readers and writers of tracking files, all with given schemas and through Spark's own sources."""
