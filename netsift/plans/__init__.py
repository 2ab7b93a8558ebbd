"""Ready-made plans over the given tables."""
