"""Target tables: create, read, upsert."""
