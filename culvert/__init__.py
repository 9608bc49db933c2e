"""culvert: stream ETL and topic routing between Kafka-shaped logs and event topics, on Spark.

Every step takes a DataFrame and returns a DataFrame built from Column
expressions, so the same code runs on a batch table and in a Structured
Streaming job.
"""
