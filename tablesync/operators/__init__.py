"""DataFrame-to-DataFrame operators: shaping, predicates, changes, merges, clustering."""
