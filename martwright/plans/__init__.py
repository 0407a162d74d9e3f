"""Table builders: source tables to conformed tables, dimensions, facts and reports."""
