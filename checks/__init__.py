"""Every operator on the given tables, each next to the SQL that must give the same rows."""

from checks import analyses, curation, events, joins, lists, profile, ranking, shaping, sources, summaries
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "analyses", "curation", "events", "joins", "lists", "profile", "ranking", "shaping",
           "sources", "summaries"]
