"""wardflow: a PySpark engine for monthly, event-driven service journeys.

Sub-packages: ``functions`` (Column → Column), ``operators`` (DataFrame →
DataFrame), ``sources`` (readers and writers), ``streaming`` (file-arrival
ingestion) and ``plans`` (the domain model and the bindings to test tables).
"""

__version__ = "0.1.0"
