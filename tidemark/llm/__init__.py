"""Operators for preparing training corpora, and their named queries."""
