"""Readers: change logs and dump files."""
