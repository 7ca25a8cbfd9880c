"""Readers of the lake's zones."""
