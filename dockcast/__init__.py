"""dockcast — station-availability analytics as Spark DataFrame plans.

Panels of five-minute station readings are cleaned, turned into leak-free
features, split by time, enriched with weather, scored by baselines and
MLlib models, and served in batch or as streams.  Every operator is a
function ``DataFrame -> DataFrame`` that stays lazy unless it fits a model.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Serialise this package's functions by value inside Python UDFs.

    Executors then need no installed copy of the package (no --py-files)
    for the few Arrow/pandas steps.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except Exception:  # pragma: no cover - pyspark always ships cloudpickle
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
