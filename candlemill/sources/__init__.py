"""Sources that add a rule to what ``spark.read`` already does."""
