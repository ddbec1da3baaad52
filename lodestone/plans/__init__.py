"""Requests over one table, and the registered queries."""

from lodestone.plans.registry import REGISTRY
from lodestone.plans import documents, groups, requests, scores, streams, texts  # noqa: F401

__all__ = ["REGISTRY"]
