"""strata: a medallion (landing -> bronze -> silver -> gold) library on PySpark.

Every function takes the caller's ``SparkSession`` or a ``DataFrame`` and
returns a ``DataFrame``; all work is expressed with built-in DataFrame / SQL
operations so Catalyst plans it and the cluster runs it.

Entry points of each layer::

    from strata import Layout, run_bronze, run_silver, build_gold, VersionedTable
"""

from strata.layout import Layout
from strata.operators.bronze import land_month, run_bronze
from strata.operators.gold import build_gold
from strata.operators.history import VersionedTable
from strata.operators.silver import run_silver

__version__ = "0.1.0"

__all__ = ["Layout", "VersionedTable", "build_gold", "land_month", "run_bronze", "run_silver"]
