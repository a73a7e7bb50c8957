"""Readers, writers and checks over landed files and tables."""
