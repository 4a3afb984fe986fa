"""Named queries and the batch rebuild."""
