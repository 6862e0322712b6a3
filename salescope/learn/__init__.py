"""Model training, metrics, ensembles and the run table."""
