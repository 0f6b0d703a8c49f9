"""Complete analyses, and the catalog of checked queries."""
