"""Nightloom: observation analytics and data preparation as Spark jobs."""
