"""lodgeflow: short-stay rental analytics expressed as Spark DataFrame jobs.

Layers (each a plain ``DataFrame -> DataFrame`` function, lazily planned by Catalyst):

* ``functions``  column-level cleansers (``Column -> Column``)
* ``sources``    CSV ingest, table sinks, the driver-table mapping
* ``operators``  history (SCD2), month expansion, as-of join, lookups, KPI marts,
                 ranking helpers, data-quality checks
* ``plans``      the named models (silver, star, marts) and the five analyses
* ``streaming``  incremental month-file ingest and per-batch snapshot apply
"""

from lodgeflow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
