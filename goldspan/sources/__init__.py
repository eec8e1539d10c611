"""Readers and writers of hub tables."""
