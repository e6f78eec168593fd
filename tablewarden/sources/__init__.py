"""Readers of run files, glossaries and storage; writers of seed files."""
