"""deskmetrics: service-desk reports on Spark DataFrames."""
