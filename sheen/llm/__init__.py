"""Training-data operators: dedup, mixing, quality, tokenizing, formatting, secrets.

Nothing else in the library imports this subpackage."""
