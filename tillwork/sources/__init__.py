"""Readers, writers and raw-record shaping."""
