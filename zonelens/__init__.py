"""Domain-infrastructure analytics as Spark DataFrame operators."""
