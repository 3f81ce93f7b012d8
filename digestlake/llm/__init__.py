"""Operators for large training corpora. Nothing else in digestlake imports this subpackage."""
