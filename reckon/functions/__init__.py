"""Column-level helpers: blank handling, text keys, predicates, lenient parsing, money, dates."""
