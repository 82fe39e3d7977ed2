"""entiscore: entity scoring from nested annotation tables on Apache Spark.

Subpackages: ``functions`` (column expressions), ``operators`` (property,
prototype, hierarchy and network operators, join helpers), ``sources``
(readers/writers and the driver-table stand-ins), ``plans`` (reports and the
query catalog), ``streaming`` (same-row measures on a stream).
"""

__version__ = "0.1.0"
