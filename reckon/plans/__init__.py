"""Jobs composed from the operators, star pulls, and the registered queries with their SQL twins."""
