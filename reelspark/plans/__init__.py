"""Registered query plans (the ``queries()`` surface) and their SQL oracles."""
