"""Column-level building blocks: predicates, formatters, running sums."""
