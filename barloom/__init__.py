"""barloom: panel analytics and forecasting as Spark DataFrame operators."""
