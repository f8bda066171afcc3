"""Query plans: serving queries and the named-query registry."""
