"""Column expressions: text forms, versions, type coercion and statistics."""
