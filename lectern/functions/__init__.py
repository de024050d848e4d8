"""Column functions: text, numbers, identities, tokens."""
