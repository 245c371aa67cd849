"""A PySpark-native event-intelligence engine."""
