"""The load step as a stream over the landing zone."""
