"""The library's operators bound to data.

``relational``, ``stats``, ``text``, ``neighbors`` and ``sources`` bind them
to the driver's test tables (the registered queries); ``bakery`` and
``jobs`` run the original jobs on their own file layouts.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name]`` (the
same question in DuckDB SQL over views of the same parquet tables) are
what ``__spark_entry__`` exposes.
"""

from __future__ import annotations

from quarry.plans import neighbors, relational, sources, stats, text

QUERIES = {}
ORACLE = {}
for _module in (relational, stats, text, neighbors, sources):
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
