"""railtempo: train-punctuality analytics as plain Spark DataFrame operators."""
