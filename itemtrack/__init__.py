"""Spark-native engine that keeps a per-market tracker of catalogue items current.

Every public function takes and returns DataFrames; the planning is left to
Catalyst and adaptive query execution.  See README.md for the module map.
"""

__version__ = "0.1.0"
