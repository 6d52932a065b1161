"""Spindrift: event-to-decision analytics and corpus preparation as PySpark DataFrame operators."""
