"""fieldcat: a Spark-native engine that turns file inventories, extracted-field
tables and ingest jobs into catalogue tables, job states and quality reports."""

__version__ = "0.1.0"
