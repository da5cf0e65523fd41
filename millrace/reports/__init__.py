import importlib
import pkgutil

from millrace.reports.registry import REPORTS, SQL  # noqa: F401

for _m in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_m.name}")
