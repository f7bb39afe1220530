"""Whole jobs assembled from the operators, and the domain rules they take."""
