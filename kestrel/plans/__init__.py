"""Model plans: staging, intermediate and mart models plus operator queries."""

from . import intermediate, marts, staging  # noqa: F401  (registers models)
from .registry import MODELS, Build, dependency_order, model  # noqa: F401
