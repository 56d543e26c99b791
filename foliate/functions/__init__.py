"""functions of foliate."""
