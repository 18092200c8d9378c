"""skyledger: Spark-native feature, graph and model analytics for large event tables.

Every public function takes DataFrames and column names and returns a lazy
DataFrame (or a fitted MLlib model). Nothing is collected to the driver except
fitted model state and a handful of bounded, explicitly documented scalars.
"""

__version__ = "0.1.0"
