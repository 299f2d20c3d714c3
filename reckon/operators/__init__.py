"""DataFrame operators: lookups, key-set joins, ordering, roll-ups, rules, pivots, comparison."""
