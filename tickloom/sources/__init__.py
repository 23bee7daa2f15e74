"""Readers and writers for landed files, payloads and tables."""
