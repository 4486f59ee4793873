"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

import importlib
import pkgutil
import sys

from pyspark import cloudpickle

# functions run on executors travel by value: executors need not have the library installed
for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")
for _name in [n for n in sys.modules if n.startswith(f"{__name__}.")]:
    cloudpickle.register_pickle_by_value(sys.modules[_name])
