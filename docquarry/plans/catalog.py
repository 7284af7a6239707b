"""All registered queries."""

from docquarry.plans import answering, evaluation, index, ingest, search, streams  # noqa: F401
from docquarry.plans.registry import QUERIES, SQL  # noqa: F401
