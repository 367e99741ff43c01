"""Readers, response normalisers and writers."""
