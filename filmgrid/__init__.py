"""Film box-office analytics written as plain Spark DataFrame code."""
