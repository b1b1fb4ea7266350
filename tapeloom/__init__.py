"""Market analytics on Spark: DataFrame operators, named plans, streams, data quality and model data."""
