"""Keep product-catalogue tables in step with their sources, as Spark jobs."""
