"""The exact sequential pass side by side: articles that cannot influence each other are filed at the same time.

An article's fate depends on the stories that are similar enough to matter (``floor``) when its turn comes.  So articles and stories are nodes of a conflict graph: articles within the window
that are that similar, articles and the open stories that are, and articles that would found a story of a name that is taken.  Each component is passed in order by one task, all
components at once.  Centroids move while members join, and may come near an article of another component: every state that a story went through is therefore held against the articles of
other components that came later.  Where one is near enough, their components are joined and passed again; where none is, no article saw less than it would have
seen in one sequence, so the result is that of the sequence: the first step that differed would have had to meet such a state.

Components only grow together, so the rounds end; at worst one component is left, which is the sequential pass.  Edges come from ``retrieval.nodes_over``, whose bounds leave out
most products; results of components that did not change are kept.  Every round's tables lie in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..functions.vectors import unit
from ..sources.scratch import materialize, scratch
from . import assign, retrieval
from .components import components


def _of_article(c: Column | str = "id") -> Column:
    return F.concat(F.lit("a"), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def _of_story(c: Column | str = "id") -> Column:
    return F.concat(F.lit("s"), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def _links(rows: DataFrame, states: DataFrame, config: Config) -> DataFrame:
    """Edges (a, b) that join articles with states that they could meet: near enough and seen within the window.  New articles only look back; orphans are tried again after
    all of them.  rows: key, phase, published_at, vector; states: key, last_seen, vector; keys are structs of block and node."""
    asked = lambda some: some.select(F.col("key").alias("id"), "published_at", "vector")
    near = lambda some, ahead: retrieval.nodes_over(asked(some), states.select(F.col("key").alias("id"), "last_seen", "vector"), assign.floor_of(config), config.candidate_window_hours, ahead)
    out = near(rows.where("phase = 0"), 0)
    again = rows.where("phase > 0")
    return out if again.isEmpty() else out.unionByName(near(again, None))


def _first_links(rows: DataFrame, known: DataFrame | None, config: Config) -> DataFrame:
    """The edges that are plain before any pass."""
    keyed = rows.where("vector is not null and size(vector) > 0").withColumn("key", F.struct("block", _of_article().alias("node")))
    out = _links(keyed, keyed.select("key", F.col("published_at").alias("last_seen"), unit(F.col("vector")).alias("vector")), config)
    if known is None:
        return out
    states = known.where("centroid is not null").select(F.struct("block", _of_story().alias("node")).alias("key"), "last_seen", F.col("centroid").alias("vector"))
    # a story of the name that an article's story would get, and of the name after that
    named = lambda text: F.concat(F.lit("s"), F.substring(F.sha1(text.cast("string").cast("binary")), 1, 16))
    names = rows.select("block", _of_article().alias("a"), named(F.col("id")).alias("id")).unionByName(known.select("block", _of_story().alias("a"), named(F.col("id")).alias("id")))
    taken = names.join(known.select("id", F.col("block").alias("theirs")), "id").where(F.col("block").eqNullSafe(F.col("theirs")))
    return out.unionByName(_links(keyed, states, config)).unionByName(taken.select("a", _of_story().alias("b")))


def _later_links(done: DataFrame, rows: DataFrame, config: Config) -> DataFrame:
    """The edges (a, b) between groups: a state that a story of one took in this pass, and an article of the other that is near it and not earlier."""
    key = F.struct(F.col("in_block").alias("block"), F.col("group").alias("node")).alias("key")
    own = rows.select("id", "phase", "published_at", "vector", F.col("block").alias("in_block"), "group")
    states = done.where("story is not null and story.article_count > 1").select("id", "story").join(own.select("id", "in_block", "group"), "id")
    return _links(own.where("vector is not null and size(vector) > 0").withColumn("key", key), states.select(key, F.col("story.last_seen").alias("last_seen"), F.col("story.centroid").alias("vector")), config).distinct()


def _regrouped(table: DataFrame, roots: DataFrame, key: Column) -> DataFrame:
    """The table with the group of its node, itself if no edge has it."""
    named = roots.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    return table.withColumn("__node", key).join(named, "__node", "left").withColumn("group", F.coalesce("__root", "__node")).drop("__node", "__root")


def assign_side_by_side(articles: DataFrame, stories: DataFrame | None = None, verifier: Callable | None = None, config: Config = Config(), with_stories: bool = False) -> DataFrame:
    """What ``assign.assign_in_order`` makes of the same articles and stories (see there), by components of the conflict graph: the same rows, but for ``step``, which counts within a
    component, and without a ``block`` that is one task.  A block, if there is one, still keeps its articles apart from those of others; ids are unique."""
    spark = articles.sparkSession
    with scratch(spark) as keep:
        rows = materialize(articles.select(*assign.COLUMNS), "queue")
        links = components(_first_links(rows, stories, config), "conflicts")
        rows = materialize(_regrouped(rows, links, _of_article()), "rows")
        held = None if stories is None else materialize(_regrouped(stories, links, _of_story()).join(rows.select("group").distinct(), "group", "left_semi"), "held")
        done, todo = None, rows
        while True:
            part = None if held is None else held.join(todo.select("group").distinct(), "group", "left_semi").withColumn("block", F.col("group")).drop("group")
            now = assign.assign_in_order(todo.withColumn("block", F.col("group")), part, verifier, config, with_stories=True)
            now = materialize(now if done is None else done.join(todo.select("id"), "id", "left_anti").unionByName(now), "passed")
            if rows.select("group").distinct().limit(2).count() < 2:
                break
            found = materialize(_later_links(now, rows, config), "links")
            if found.isEmpty():
                break
            joined = components(found, "conflicts")
            touched = joined.select(F.col("root").alias("group")).distinct()
            rows = materialize(_regrouped(rows, joined, F.col("group")), "rows")
            held = None if held is None else materialize(_regrouped(held, joined, F.col("group")), "held")
            done, todo = now, rows.join(touched, "group", "left_semi")
        blocks = rows.select("id", F.col("block").alias("in_block"))
        out = now.drop("block").join(blocks, "id").withColumnRenamed("in_block", "block").select(*now.columns)
        keep(now, rows)
    return out if with_stories else out.drop("story")
