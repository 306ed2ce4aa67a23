"""Curation of species-occurrence observations as Spark DataFrame jobs."""

from occflow.spec import RunSpec

__all__ = ["RunSpec"]
