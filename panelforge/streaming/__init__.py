"""Month-by-month processing as a micro-batch stream."""
