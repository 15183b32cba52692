"""alloy: incremental, quality-gated sheet -> bronze -> silver loading on Spark.

Subpackages: ``functions`` (Column expressions), ``sources`` (landed grids,
derived fixtures), ``operators`` (validate, bronze, silver, state), ``sinks``
(table layout), ``plans`` (pipeline and query catalogue), ``streaming``
(availableNow wrapper).
"""

__version__ = "0.1.0"
