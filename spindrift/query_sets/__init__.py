"""Registered queries by subject."""
