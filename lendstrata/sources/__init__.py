"""Contracts, readers, writers and staging."""
