"""Spark-first analytics over logs of assistant and agent sessions."""
