"""Everything that reads from or writes to storage."""
