"""The registered queries, one per operator, each with the SQL that must agree."""

from askloom.catalog import chat, evaluation, files, ingest, search, text  # noqa: F401  (they register)
from askloom.catalog.base import REGISTER

__all__ = ["REGISTER"]
