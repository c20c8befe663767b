"""Trip-fare analytics on Spark: ingest, cleaning, features, profiling, demand,
splitting, model training and scoring as DataFrame operators."""
