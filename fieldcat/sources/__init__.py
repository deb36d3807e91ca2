"""Sources: driver tables, file inventories, mapping documents, job inputs."""

from fieldcat.sources.tables import read_table, TABLES

__all__ = ["read_table", "TABLES"]

import sys

from pyspark import cloudpickle

# Readers travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
