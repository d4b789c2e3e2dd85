"""Registered queries: operators bound to the business tables, with their SQL."""
