"""Supply-chain analytics on Spark: raw files to conformed tables to KPI tables.

Every operator takes DataFrames and plain parameters and returns a DataFrame.
Only ``sources.store``, ``plans.runner`` and ``streaming`` touch storage.
"""

__version__ = "0.1.0"
