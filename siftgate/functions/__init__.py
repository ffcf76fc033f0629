"""Column functions: coercion, cleaning, hashing, text."""
