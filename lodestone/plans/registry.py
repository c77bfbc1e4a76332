"""All registered queries."""

from lodestone.plans import answers, ingest, search, write  # noqa: F401
from lodestone.plans.base import QUERIES, SQL  # noqa: F401
