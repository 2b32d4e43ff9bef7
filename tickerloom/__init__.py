"""Market-news analytics as user-level DataFrame operators on Spark."""
