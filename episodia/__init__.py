"""Spark-native analytics for recorded demonstration and sensor trajectories."""
