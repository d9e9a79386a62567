"""Web-event analytics and training-text preparation as Spark DataFrame operators."""
