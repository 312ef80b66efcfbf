"""Trade analytics on Spark: landing, cleansing, star schema, measures and report queries."""
