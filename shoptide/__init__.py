"""Shop activity analytics as Spark DataFrame functions, for tables and for streams."""
