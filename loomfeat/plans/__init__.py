"""Feature blocks as specs over the operators, and the query catalogue."""
