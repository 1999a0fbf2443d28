"""Customer-retention and staff-utilisation analytics as Spark DataFrame transformations."""
