"""functions of the proposal analytics library."""
