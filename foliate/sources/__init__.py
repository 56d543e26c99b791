"""sources of foliate."""
