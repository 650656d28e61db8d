"""Readers and request planning."""
