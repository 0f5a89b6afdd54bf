"""Time-aligned analytics and data preparation on Spark."""
