"""Scalar building blocks: casts, dates and ratios."""
