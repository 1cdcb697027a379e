"""quarry: PySpark-native analytics operators.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame.  The work is expressed with the DataFrame API so Catalyst can
push filters and projections into the scans, pick join strategies, and plan
partial aggregation.  Two operators run jobs while they build their plan and
write intermediate tables (see ``quarry.operators.common.Scratch``):
``nearest_vectors`` (pivots, cells, radii) and ``dice_join`` (word sets and
their listings).  Only bounded parameters reach the driver.

Sub-packages:

* ``quarry.sources``   -- readers (CSV, multi-line JSON, text with path,
                           bracketed distance records, parquet tables) and sinks
* ``quarry.functions`` -- column-expression helpers (cleaning, tokenising,
                           guarded arithmetic)
* ``quarry.operators`` -- relational, statistical, text-similarity and
                           nearest-neighbour operators
* ``quarry.plans``     -- the operators bound to the driver's test tables
"""

__version__ = "0.1.0"


def _ship_code_with_tasks() -> None:
    """Have Spark serialise this package's functions by value.

    The few Arrow-batched stages (kNN cell assignment and block kernel) run
    functions of this package inside the Python workers.  Pickled by value,
    they reach every executor with the task itself, so the package does not
    have to be installed there or be on the workers' path.
    """
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pyspark without its bundled cloudpickle: install the package instead
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_code_with_tasks()
