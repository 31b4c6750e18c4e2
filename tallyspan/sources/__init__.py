"""Readers, writers and the file audit."""
