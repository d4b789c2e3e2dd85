"""All registered queries of the structural operators."""

from helixframe.plans import entries, features, graphs, ingest, structures  # noqa: F401
from helixframe.plans.base import ORACLES, QUERIES  # noqa: F401
