"""Record harvest, enrichment and snapshot jobs as Spark DataFrame transformations."""
