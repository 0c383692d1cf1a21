"""Column-level functions: parsing, formatting, rule matching, hashing (all Catalyst expressions)."""
