"""Public-record analytics on Spark."""
