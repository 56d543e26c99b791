"""plans of foliate."""
