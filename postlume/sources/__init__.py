"""Source tables and how they map to the common post schema."""
