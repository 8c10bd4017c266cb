"""Daily-bar signal and trade analytics as Spark DataFrame operators."""
