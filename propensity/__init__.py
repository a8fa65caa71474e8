"""Customer analytics on PySpark: features, models, metrics, ensembles and score tables."""
