"""operators of the proposal analytics library."""
