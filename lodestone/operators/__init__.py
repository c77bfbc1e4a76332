"""DataFrame operators: search, write path, catalog, retrieval, sessions, lineage."""
