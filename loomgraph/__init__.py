"""Record-graph engine on Spark: from repository metadata and test sheets to a graph of typed records."""
