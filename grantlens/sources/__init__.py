"""sources of the proposal analytics library."""
