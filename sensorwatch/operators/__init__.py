"""Relational operators: window averages, rule matching."""
