"""Send this package's Python functions to executors by value.

Executors need not have the package installed: functions defined in a
registered module travel with their code instead of as an import.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(module_name: str) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


# modules that travel whole hold a reference to the function above
by_value(__name__)
