"""Registered queries: every operator and job on the driver tables, with SQL to check it."""

from registry import joins, jobs, reshape, text, vectors
from registry.stand_ins import Tables

MODULES = (joins, reshape, text, vectors, jobs)
__all__ = ["MODULES", "Tables"]
