"""All registered core queries and their SQL."""

from quern.plans import audits, pipelines, tables, texts  # noqa: F401 - they register their queries
from quern.plans.registry import ORACLES, QUERIES  # noqa: F401
