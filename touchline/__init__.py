"""touchline: football match and player analytics as plain Spark jobs."""
