"""fleetscope: fleet metric reports (usage profiles, shares, reports) on Spark.

Public entry points:

* ``fleetscope.sources``   - read, ingest, view, cache, write tables
* ``fleetscope.operators`` - membership, distinct keys, profiles, shares
* ``fleetscope.plans``     - client and overall reports, test fixtures, query catalog
* ``fleetscope.streaming`` - exactly-once ingest of landed files
"""

__version__ = "0.1.0"
