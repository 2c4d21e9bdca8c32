"""strata: a PySpark-native retail warehouse (raw -> silver -> gold) and
grid-telemetry alerting engine.

Every table is a ``DataFrame -> DataFrame`` function; nothing is collected
to the driver.  Sub-packages:

* ``sources``   -- raw landing readers (JSON / CSV / parquet -> variant payload)
                   and the binding of the driver's test tables to retail feeds.
* ``operators`` -- load patterns (latest-per-key, type-1/type-2 upsert,
                   insert-if-absent, partition replace) and scale-safe global
                   keys / ranks / ntiles.
* ``functions`` -- column helpers shared by all layers (guarded ratios,
                   calendar differences, date keys).
* ``plans``     -- the silver jobs, gold dimensions, facts and marts, and the
                   ``Warehouse`` that wires them together lazily.
* ``streaming`` -- Structured Streaming ingest and the telemetry alert job.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
