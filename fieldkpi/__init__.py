"""fieldkpi: weekly field-intervention analytics as Spark DataFrame operators.

Layers:
  functions/  Column -> Column scalar rules (text folding, ID cascade, contact class)
  operators/  DataFrame -> DataFrame operators (zone join, classification,
              evolution windows, weekly KPIs)
  sources/    readers, writers, catalog helpers, driver-table adapters
  plans/      end-to-end jobs: clean history, dashboard payload, sheet reports, views
  streaming/  incremental ingest of landed reports with Structured Streaming
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value so Python workers (executors)
    need no installed copy of it."""
    import sys

    try:
        from pyspark import cloudpickle
    except Exception:  # pragma: no cover - pyspark absent
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
