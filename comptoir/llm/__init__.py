"""Operators that prepare training data for language models, and their queries.

Nothing else in the library imports this subpackage.
"""
