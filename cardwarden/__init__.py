"""Card-transaction risk jobs on Spark: ingest, features, models, scoring, reports."""
