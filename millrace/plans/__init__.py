"""Plans as values: predicates, table definitions, schema checks."""
