"""operators of foliate."""
