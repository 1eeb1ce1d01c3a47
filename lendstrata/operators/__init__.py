"""Relational operators, ``DataFrame -> DataFrame``, built from Catalyst expressions only."""
