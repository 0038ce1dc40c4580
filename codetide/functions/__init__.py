"""Column expressions: ids, text facts, paths and symbols."""
