"""Column builders: expressions, periods, domain recodes, schema helpers."""
