"""landlens: land-value analytics as Spark DataFrame operators.

Layout
------
- ``landlens.session``     session helper and the shared checkpoint folder
- ``landlens.contracts``   typed table contracts and the fixed class maps
- ``landlens.functions``   Column-level expressions (classes, casts, text, geometry)
- ``landlens.sources``     readers, sinks and the named-result catalog
- ``landlens.operators``   DataFrame-in / DataFrame-out operators
- ``landlens.plans``       the cleaning jobs and the named results composed from operators,
                           plus bindings to the driver's test tables
- ``landlens.llm``         operators for training-data corpora (nothing else imports them)

Every operator takes and returns a ``pyspark.sql.DataFrame``; outside ``llm`` all
use built-in Spark functions only, so Catalyst can prune, push down and
code-generate the whole plan.
"""

__all__ = ["session", "contracts", "functions", "sources", "operators", "plans"]
