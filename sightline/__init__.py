"""Spark-native analytics for sequences of sightings and their scores."""

from sightline.session import build_session

__all__ = ["build_session"]
