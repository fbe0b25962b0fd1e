"""Readers, writers and literal relations."""
