"""Spark-native analytics over dated snapshots of a project backlog."""
