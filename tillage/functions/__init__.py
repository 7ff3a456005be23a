"""Column functions: text, hashing, URLs, term matching."""
