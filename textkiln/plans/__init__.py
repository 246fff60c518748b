"""Registered queries and their DuckDB SQL."""

from textkiln.plans import collect, dedup, estimates, pairs, pipelines, scalars, streams
from textkiln.plans.base import QUERIES, SQL
