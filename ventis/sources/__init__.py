"""Readers, writers and the star schema."""
