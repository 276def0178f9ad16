"""Readers, writers and landing-page parsers."""
