"""sources of digestlake."""
