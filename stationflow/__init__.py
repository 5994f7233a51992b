"""stationflow: station time series on Spark - ingest, rollups, features, labels, models, forecasts."""
