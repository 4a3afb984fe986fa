"""Online versions of the sequential jobs."""
