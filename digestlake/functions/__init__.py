"""functions of digestlake."""
