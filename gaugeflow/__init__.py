"""Preparation, repair and forecasting of fixed-interval sensor series on Spark."""
