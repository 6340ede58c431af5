"""Notice ingestion, reconciliation and reporting on Spark DataFrames."""
