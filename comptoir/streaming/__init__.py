"""Sales events as a stream."""
