"""Demand-planning analytics as Spark DataFrame plans."""
