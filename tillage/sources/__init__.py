"""Readers, writers and search providers."""
