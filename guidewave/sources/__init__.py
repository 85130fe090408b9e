"""Readers and writers of screen inputs and results."""
