"""Event and ticketing analytics as Spark DataFrame operators."""
