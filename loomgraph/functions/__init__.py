"""Column functions, fixed vocabularies and helpers."""
