"""plans of digestlake."""
