"""casegrade: a PySpark pipeline that scores insurance claims for complexity.

Layers (each a plain DataFrame -> DataFrame function, so Catalyst compiles
the whole chain into one plan):

* ``sources``   – fixture tables built from the supplied test tables, file
                  landing and file listings.
* ``streaming`` – incremental CSV / JSON ingest into raw (bronze) tables.
* ``operators`` – staging, medical flags, scoring, gold mart, data-quality
                  tests, file ledger, skew-safe join.
* ``functions`` – column expressions (casts, text clean-up, scoring rules,
                  JSON payload helpers).
* ``plans``     – the end-to-end pipeline, catalog setup and the query
                  registry used by ``__spark_entry__``.
"""

__version__ = "0.1.0"
