"""Readers and writers of files, literals, payloads and query strings."""
