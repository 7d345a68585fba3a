"""Column functions: patterns, text scalars, the markup sanitizer."""
