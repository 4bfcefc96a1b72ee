"""Rechecking earlier assignments: which members to ask about, what the answers change, and the reports on them."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..config import Config
from ..functions.scoring import verified, verify_reason
from ..functions.text import placeholder_title
from . import models
from .assign import RULE
from .stories import founders

CUTS = (0.5, 0.6, 0.66, 0.7, 0.75, 0.8, 0.85, 0.9)


def reanchored(stories: DataFrame, articles: DataFrame) -> DataFrame:
    """Stories with their founder, and the summary and title taken back from it where a model had rewritten the title."""
    f = founders(articles).join(articles.select(F.col("id").alias("founder_id"), F.col("event_summary").alias("anchor")), "founder_id")
    rows = stories.join(f.select("story_id", "founder_id", "anchor"), stories["id"] == F.col("story_id"), "left").drop("story_id")
    drifted = (F.col("title_source") == "llm") & F.col("anchor").isNotNull() & ~F.col("anchor").eqNullSafe(F.col("summary"))
    return (
        rows.withColumn("changed", F.coalesce(drifted, F.lit(False)))
        .withColumn("title", F.when(F.col("changed"), placeholder_title("anchor")).otherwise(F.col("title")))
        .withColumn("summary", F.when(F.col("changed"), F.col("anchor")).otherwise(F.col("summary")))
        .withColumn("title_source", F.when(F.col("changed"), "auto").otherwise(F.col("title_source")))
        .drop("anchor")
    )


def suspects(stories: DataFrame, articles: DataFrame, config: Config = Config(), most: int | None = None) -> DataFrame:
    """Members that the present rule would have sent to the verifier and that were not decided under it; founders are exempt.

    stories: id, founder_id, first_seen, event_date, of open ones with two articles or more.  articles: with ``rule`` and ``method``.
    """
    s = stories.where("status = 'open' and article_count >= 2").select(F.col("id").alias("story_id"), "founder_id", "first_seen", F.col("event_date").alias("story_date"))
    rows = articles.join(s, "story_id")
    exempt = (F.col("id") == F.col("founder_id")) | (F.col("founder_id").isNull() & (F.col("method") == "create"))
    reason = verify_reason(F.col("published_at"), F.col("event_date"), F.col("first_seen"), F.col("story_date"), config)
    rows = rows.where(~F.coalesce(F.col("rule") == RULE, F.lit(False)) & ~F.coalesce(exempt, F.lit(False))).withColumn("reason", reason).where("reason is not null")
    rows = rows.select("story_id", "id", "published_at", "reason")
    return rows if most is None else rows.orderBy("story_id", "published_at", "id").limit(most)


ANSWERS = "id {0}, candidate_id string, relation string, confidence double, reason string, error string"


def answered(asked: DataFrame, stories: DataFrame, articles: DataFrame, make: Callable[[], models.Verifier]) -> DataFrame:
    """A verifier's answer for each suspect, asked about its own story alone; a call that fails has an error and no relation."""
    s = stories.select(F.col("id").alias("story_id"), F.struct(F.col("id").cast("string").alias("id"), "title", "summary", "event_date", "first_seen").alias("story"))
    a = articles.select("id", F.struct("outlet", "published_at", "title", "event_summary", "event_date", "key_entities").alias("article"))
    rows = asked.select("id", "story_id").join(s, "story_id").join(a, "id").select("id", F.to_json("article").alias("article"), F.to_json("story").alias("story"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        verifier = models.ModelVerifier(make)
        read = lambda text: json.loads(text, object_hook=lambda d: SimpleNamespace(**{"event_date": None, "first_seen": None, "title": None, "summary": None} | d))
        for b in batches:
            out = []
            for i, article, story in zip(b["id"], b["article"], b["story"]):
                try:
                    x = verifier(read(article), [read(story)])
                    sure = pd.to_numeric(x.get("confidence"), errors="coerce")
                    out.append((i, x.get("candidate_id"), x.get("relation"), 0.0 if pd.isna(sure) else float(sure), x.get("reason"), None))
                except Exception as error:  # noqa: BLE001
                    out.append((i, None, None, None, None, str(error)[:300]))
            yield pd.DataFrame(out, columns=["id", "candidate_id", "relation", "confidence", "reason", "error"])

    return rows.mapInPandas(run, ANSWERS.format(articles.schema["id"].dataType.simpleString()))


def report(decisions: DataFrame, before: DataFrame, stories: DataFrame, articles: DataFrame) -> DataFrame:
    """One row a decision with the story's title before and after re-anchoring, in eleven columns; for write_tsv."""
    old = before.select(F.col("id").alias("story_id"), F.col("title").alias("story_title_before"))
    new = stories.select(F.col("id").alias("story_id"), F.col("title").alias("story_anchor"))
    a = articles.select("id", "outlet", F.col("title").alias("headline"))
    rows = decisions.select("story_id", "id", "published_at", "relation", "confidence", "decision", F.col("answer_reason").alias("reason")).join(old, "story_id").join(new, "story_id").join(a, "id")
    return rows.select("story_id", "story_title_before", "story_anchor", F.col("id").alias("article_id"), "outlet", "published_at", "headline", "relation", F.format_number("confidence", 2).alias("confidence"), "decision", F.translate("reason", "\t", " ").alias("reason"))


def judged(asked: DataFrame, answers: DataFrame, config: Config = Config()) -> DataFrame:
    """Each asked member with the answer's decision: kept or detached.  answers: id, candidate_id, relation, confidence."""
    rows = asked.join(answers.withColumnRenamed("reason", "answer_reason") if "reason" in answers.columns else answers, "id")
    verdict = verified(F.col("relation"), F.col("confidence"), F.col("candidate_id") == F.col("story_id"), F.lit(True), config)
    return rows.withColumn("decision", F.when(verdict.isNull(), "detached").otherwise("kept"))


def applied(articles: DataFrame, decisions: DataFrame) -> DataFrame:
    """Articles after a recheck: detached ones lose story, side and time and remember the story; kept ones carry the rule."""
    d = decisions.select("id", "decision")
    rows = articles.join(d, "id", "left")
    out, kept = F.col("decision") == "detached", F.col("decision") == "kept"
    rows = rows.withColumns({
        "from_story": F.when(out, F.col("story_id")).otherwise(F.col("from_story")), "method": F.when(out, "detached").otherwise(F.col("method")),
        "rule": F.when(out | kept, RULE).otherwise(F.col("rule")),
    })
    null = lambda c: F.when(out, F.lit(None)).otherwise(F.col(c))
    return rows.withColumns({c: null(c) for c in ("story_id", "side", "assigned_at")}).drop("decision")


def counters() -> dict[str, Column]:
    """What became of the suspects, as aggregates over the decisions: observed while these are written."""
    return {"suspects": F.count(F.lit(1)), "kept": F.count_if(F.col("decision") == "kept"), "detached": F.count_if(F.col("decision") == "detached")}


def histogram(answers: DataFrame, cuts: tuple[float, ...] = CUTS) -> DataFrame:
    """For each cut how many answers that would split are at least so sure: one aggregate over the answers, then unpivoted."""
    split = answers.where(F.col("relation").isin("follow_up", "unrelated"))
    row = split.agg(*[F.count_if(F.col("confidence") >= c).alias(f"c{i}") for i, c in enumerate(cuts)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("cut"), F.col(f"c{i}").alias("n")) for i, c in enumerate(cuts)])).alias("x")).select("x.*")


def borderline(answers: DataFrame, most: int = 40) -> DataFrame:
    """The answers that would split with a confidence from 0.50 to under 0.85, least sure first."""
    rows = answers.where(F.col("relation").isin("follow_up", "unrelated") & (F.col("confidence") >= 0.5) & (F.col("confidence") < 0.85))
    return rows.orderBy("confidence", "id").limit(most)
