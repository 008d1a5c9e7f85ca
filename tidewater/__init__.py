"""tidewater: a Spark-native trip lakehouse and table-metadata library.

Two halves, both plain DataFrame -> DataFrame functions on the public PySpark API:

* taxi lakehouse: header-checked CSV scans, header harmonisation, schema-era merges,
  lenient casts, partitioned zone tables (``tidewater.plans.taxi``);
* table metadata: watermarks, column profiles, a node/edge metadata graph, search
  documents and guarded expiry of stale relations (``tidewater.plans.refresh``).

No function here sets session configuration or stops the session.
"""

__version__ = "0.1.0"
