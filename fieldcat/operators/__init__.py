"""Operators: DataFrame(s) + parameters -> DataFrame. No actions inside,
except the sinks in ``sinks``."""
