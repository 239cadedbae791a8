"""fleet: many-model forecasting, boosted trees, search and vector retrieval as Spark jobs."""
