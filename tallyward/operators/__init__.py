"""DataFrame operators: every function takes column names and returns a plan."""
