"""Column functions: ids, names, maps, text and vectors."""
