"""Readers and writers of delimited text."""
