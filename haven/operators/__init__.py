"""DataFrame -> DataFrame operators: conform, star, quality, upsert, metrics."""
