"""Operators for building training corpora out of raw text, and their queries.

Nothing else in the library imports this subpackage.
"""
