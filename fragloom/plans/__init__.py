"""Stored splits: file layout, catalog, store, registered queries."""
