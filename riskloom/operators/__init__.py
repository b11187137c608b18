"""Relational operators of the risk library (DataFrame in, DataFrame out)."""
