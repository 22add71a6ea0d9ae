"""sheen: a Spark-native product-review recommendation engine.

Every operator takes and returns a DataFrame and is built from Spark SQL and
Spark ML primitives. Modules:

* ``sources``   - fixture views over the test tables, CSV/Parquet sources and sinks
* ``functions`` - column expressions (text cleaning, tokenising, HTML fields, vector math)
* ``operators`` - page extraction, cleaning, relational steps, ingredient grouping,
  features and neighbours, factor models, collaborative filtering, serving
* ``plans``     - the registry of named queries and their DuckDB oracle SQL
* ``streaming`` - the page-extraction plan applied to a stream of stored pages
"""

__version__ = "0.1.0"
