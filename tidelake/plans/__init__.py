"""Layer builds composed from the operators."""
