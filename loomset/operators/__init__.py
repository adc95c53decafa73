"""DataFrame-to-DataFrame steps built from the column expressions."""
