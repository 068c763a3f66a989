"""DataFrame -> DataFrame operators: parse, route, transform, validate."""
