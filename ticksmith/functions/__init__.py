"""Column functions: JSON tick codec, quote lookup, keys and time helpers."""
