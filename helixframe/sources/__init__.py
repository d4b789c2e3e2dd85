"""Readers of the domain's text formats as plain tables."""
