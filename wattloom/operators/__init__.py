"""DataFrame operators. Each takes and returns DataFrames and names its columns by parameter."""
