"""cutpoint: Spark-native risk scoring, decision policies and monitoring.

Every public function takes and returns DataFrames; nothing iterates over
collected rows except small, explicitly bounded lookups (quantile bounds,
threshold cut lists, single-row scalars).
"""

__version__ = "0.1.0"
