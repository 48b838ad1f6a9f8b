"""cueflow streaming."""
