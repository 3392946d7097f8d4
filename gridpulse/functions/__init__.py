"""Column functions: calendar, bands, features, predicates."""
