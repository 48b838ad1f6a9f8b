"""cueflow operators."""
