"""Plans over the driver tables: derived inputs, the query catalog and their SQL twins."""
