"""Features, recommendations and drift monitoring as Spark DataFrame operators."""
