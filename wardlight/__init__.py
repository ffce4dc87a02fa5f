"""Provider quality analytics as Spark DataFrame operators."""
