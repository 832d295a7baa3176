"""Registry analytics as composable Spark DataFrame operators."""
