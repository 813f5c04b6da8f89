"""playmill: record analytics as lazy Spark DataFrame plans."""
