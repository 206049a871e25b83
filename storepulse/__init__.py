"""storepulse: retail KPI reports (sales, margin, targets, inventory, customers) on Spark.

Layout:

* ``sources``   -- schemas, readers for landed extracts, adapters from star-schema tables
* ``functions`` -- column expressions: economics, dates and windows, buckets, filters
* ``operators`` -- the reports: windowed totals, inventory grids, customers, lot model
* ``plans``     -- session settings, staging, the registered queries and their SQL
* ``sinks``     -- report writers
"""

__version__ = "0.1.0"
