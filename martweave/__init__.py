"""Star-schema analytics for e-commerce finance, written as Spark jobs."""
