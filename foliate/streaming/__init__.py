"""streaming of foliate."""
