"""DataFrame operators: projections, filters, joins, aggregations, routing, upserts,
integrity checks, sequences and change-set rewriting."""
