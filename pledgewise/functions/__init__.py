"""Column functions: rubric, fiscal periods, identifiers, text patterns and guards."""
