"""Card-transaction risk analytics as composable Spark DataFrame operators."""
