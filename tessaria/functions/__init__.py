"""Column functions and vocabularies."""
