"""Text-corpus preparation and subword-vocabulary training as Spark jobs."""
