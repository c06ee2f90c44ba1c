"""Pipelines from topic to topic, and the registered queries."""
