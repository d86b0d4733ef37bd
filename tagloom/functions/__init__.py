"""Column expressions used by the tag jobs; all of them built-in Spark functions."""
