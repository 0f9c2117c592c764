"""Spark DataFrame operators and ready-made analyses for a media catalog and its viewing events."""

from reelmill.session import build_session

__all__ = ["build_session"]
