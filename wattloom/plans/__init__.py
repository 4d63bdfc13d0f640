"""The questions as compositions of operators, their SQL twins, and the published key families."""
