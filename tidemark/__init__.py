"""tidemark: order data-quality and analytics as Spark DataFrame plans.

Layers, each a ``DataFrame -> DataFrame`` step:

* ``sources``   - declared schemas, CSV ingest with lineage, sinks, catalog reports, fixtures
* ``functions`` - column-level cleaners and derived columns (``Column -> Column``)
* ``operators`` - table transforms, the rule model and engine, quality reports, marts
* ``plans``     - the rule registries and the end-to-end run
* ``streaming`` - intentionally empty (the workload is batch only)
"""

__all__ = ["sources", "functions", "operators", "plans"]
