"""Expressions on columns."""
