"""Column expressions: codes, hashes and JSON bodies."""
