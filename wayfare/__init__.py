"""Ride-hailing order and trajectory analytics as plain Spark DataFrame operators."""
