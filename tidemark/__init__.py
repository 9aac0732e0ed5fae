"""Tidemark: change-data ingestion, slowly changing dimensions and star schemas on plain Apache Spark."""
