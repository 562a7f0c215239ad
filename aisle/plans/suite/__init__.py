"""The 103 statements of the retail decision-support suite, one function each."""

import importlib
import pkgutil


def load_suite():
    for m in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{m.name}")
