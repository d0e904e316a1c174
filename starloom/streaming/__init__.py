"""Source files as a stream."""
