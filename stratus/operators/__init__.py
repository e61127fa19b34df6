"""Relational and positional operators over observation series."""
