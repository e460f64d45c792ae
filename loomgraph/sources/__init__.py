"""Readers of landed files, and writers of record graphs."""
