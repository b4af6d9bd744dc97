"""Relational and analytical operators (DataFrame in, DataFrame out)."""
