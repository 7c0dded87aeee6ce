"""Training-data operators: sharding, fingerprints, token files, joins, filters, packing."""
