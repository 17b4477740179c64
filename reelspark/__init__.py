"""Ratings analytics and recommendation expressed as Spark DataFrame jobs."""
