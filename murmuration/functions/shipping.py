"""Python code that workers can run without this package being installed there.

``pyspark.cloudpickle`` pickles a function of an importable module by its name,
so a worker that lacks the package fails with ``ModuleNotFoundError``.  A
module that calls ``ship_by_value(__name__)`` has its functions (and what they
refer to inside other such modules) pickled with their code instead.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
