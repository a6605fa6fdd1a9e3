"""layerwise — layered (raw → cleaned → aggregate) analytics on Spark DataFrames.

Every public operator takes DataFrames plus column names and returns a lazy
DataFrame; nothing is collected to the driver.  Sub-packages:

* ``functions`` – column expressions (tolerant casts, defaults, text, names, Elo formula)
* ``operators`` – DataFrame → DataFrame operators (dedup, quality, upsert,
  standings, snapshots, predictions, serving queries, cleaning)
* ``sources``   – CSV / Parquet / JDBC landing and reading, ingest manifest
* ``plans``     – fixtures over the benchmark tables, the layered job, query catalogue
"""

__version__ = "0.1.0"
