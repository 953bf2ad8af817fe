"""Social-post and price-move analytics as PySpark DataFrame jobs."""
