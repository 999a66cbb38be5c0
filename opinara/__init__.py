"""Review analytics as Spark jobs: cleaning, sentiment, topics, warehouse, reporting."""
