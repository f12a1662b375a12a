"""Relational operators over change logs and control tables."""
