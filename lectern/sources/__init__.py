"""Readers and writers of files and catalogs."""
