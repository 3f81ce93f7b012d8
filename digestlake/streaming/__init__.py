"""streaming of digestlake."""
