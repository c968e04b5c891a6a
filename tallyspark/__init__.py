"""tallyspark: loyalty point-of-sale reconciliation, CRM migration and profile
matching, written as Spark DataFrame jobs.

Layout
------
- ``schemas``     declared table layouts (StructType) and neutral table names
- ``sources``     delimited-file readers, prefix discovery, import counts
- ``sinks``       overwrite / append writers, JSON-lines export, bulk payload chunks
- ``functions``   column expressions (timestamp parsing, kind, amount, row JSON)
- ``operators``   set difference, member resolution, reconciliation, profiles,
                  back-fill, key assignment, migration, quality checks
- ``plans``       end-to-end jobs and the registry of named queries
- ``streaming``   file-source ingest with archive of consumed files
- ``fixtures``    bindings of the driver's synthetic tables to the input layouts
"""

__version__ = "0.1.0"
