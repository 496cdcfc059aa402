"""Media-collection analytics as Spark DataFrame plans."""
