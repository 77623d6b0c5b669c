"""Named queries over the test tables, each with the SQL that checks it."""

from . import activities, conformance, gold, html, identity, quality, scalars, stream, structure, toolfiles
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "activities", "conformance", "gold", "html", "identity", "quality", "scalars", "stream", "structure", "toolfiles"]
