"""prefdata: preference- and instruction-data preparation as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; random choices are keyed md5 hashes so results do not depend on
partitioning and can be checked against a SQL oracle.
"""

__version__ = "0.1.0"
