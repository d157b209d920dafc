"""Activity, sleep and workout analytics as Spark DataFrame jobs."""
