"""DataFrame operators: numbering, splitting, counting, checking."""
