"""operators of digestlake."""
