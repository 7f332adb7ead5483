"""skyledger — climate time-series analytics on Spark.

Landed weather-API documents are flattened into typed raw tables, deduplicated,
joined to a location dimension, enriched with rolling 30-row means, turned into
daily / hourly fact tables, alerts and a calendar dimension, and served by a set
of parametrised analytical reports and data-quality checks.  Everything is a
``DataFrame -> DataFrame`` function built from Spark SQL built-ins.
"""

__version__ = "0.1.0"
