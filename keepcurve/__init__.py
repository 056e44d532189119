"""keepcurve: subscriber-retention analytics as Spark DataFrame operators.

Every public function takes DataFrames (plus column names and parameters)
and returns a DataFrame; the heavy work is a Spark plan, never a pandas
frame on the driver.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value for Python workers, so
    pandas UDF / applyInPandas helpers run on executors that do not have
    the package installed (cluster or a different working directory)."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - optional optimisation of deployment
        pass


_ship_by_value()
