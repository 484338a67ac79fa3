"""Part of fieldmart."""
