"""Relational operators: tumbling aggregates, filters, quality splits."""
