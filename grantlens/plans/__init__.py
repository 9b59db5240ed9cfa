"""plans of the proposal analytics library."""
