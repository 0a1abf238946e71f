"""Column -> Column helpers; everything here stays inside Spark expressions."""
