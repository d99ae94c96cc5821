"""Airline on-time-performance analytics expressed as Spark DataFrame operators."""
