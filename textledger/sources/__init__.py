"""Reading messages, and writing tables."""
