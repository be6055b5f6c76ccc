"""Readers, writers and the panel recipe."""
