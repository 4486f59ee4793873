"""Named queries over the benchmark tables, each with the SQL that checks it."""

from grantflow.queries import changes, documents, lookups, mails, metrics, sheets, upkeep
from grantflow.queries.base import REGISTRY

__all__ = ["REGISTRY", "changes", "documents", "lookups", "mails", "metrics", "sheets", "upkeep"]
