"""Configuration-driven data pipelines and model evaluation as Spark jobs."""
