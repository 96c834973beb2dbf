"""Daily regional snow-hazard bulletins as Spark table jobs."""
