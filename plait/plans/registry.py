"""All registered queries of the story engine and their SQL."""

from . import scalar_queries, story_queries

QUERIES = scalar_queries.QUERIES | story_queries.QUERIES
SQL = scalar_queries.SQL | story_queries.SQL
