"""E-commerce analytics on Spark: raw tables, staging models, marts, reports."""
