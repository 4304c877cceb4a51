"""Knowledge-graph table preparation as Spark DataFrame plans."""
