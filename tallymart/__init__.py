"""Survey microdata to star schema, as plain Spark DataFrame plans."""

__version__ = "0.1.0"
