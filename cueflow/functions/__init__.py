"""cueflow functions."""
