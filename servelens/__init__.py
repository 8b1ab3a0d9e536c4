"""servelens: account-cost and what-if scenario analytics on Spark.

Everything is expressed with Spark DataFrame operators so that the same code
runs on a laptop (``local[*]``) and on a cluster.  Sub-packages:

* ``sources``   -- readers, typed layer, binding views over the TPC-H-like test data
* ``functions`` -- small column-expression helpers (null-safe predicates, labels)
* ``operators`` -- reusable relational building blocks (upsert, carry-forward, ...)
* ``plans``     -- the composite operators users call (constraints, scenarios, reporting)
* ``sinks``     -- writers (snapshots, dated reports, wide account columns)
* ``streaming`` -- incremental variant of the monthly transfer aggregation
"""

__version__ = "0.1.0"
