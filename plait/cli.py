"""Commands over published tables: ``python -m plait.cli COMMAND --root FOLDER ...``; ``--dry-run`` writes nothing."""

from __future__ import annotations

import argparse
import dataclasses
import json
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .config import Config, from_environment
from .operators import assign, enrich, ingest, models, recheck, reports, stories as S
from .plans import flow
from .sources import pages as P, registry, tables
from .sources.feeds import FeedSource, named

TABLES = ("sources", "articles", "stories", "pairs")


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return tables.latest(spark, root, name)


def _stamp() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")


def _write(df: DataFrame, root: str, name: str, dry: bool) -> DataFrame:
    """The next version of a table beside the old one, which later commands read; a dry run only counts."""
    if dry:
        print(json.dumps({"table": name, "rows": df.count(), "dry_run": True}))
        return df
    stamp = _stamp()
    out = tables.publish(df, f"{root}/versions/{name}-{stamp}")
    print(json.dumps({"table": name, "version": stamp}))
    return out


def _model(args):
    """The factory of the model that --model names (module:factory), or None."""
    return named(args.model) if args.model else None


def _verifier(args):
    return models.ModelVerifier(_model(args)) if args.model else None


def _merger(args):
    return models.ModelMerger(_model(args)) if args.model else None


def _now(args) -> F.Column:
    return F.lit(datetime.fromisoformat(args.now)) if args.now else F.lit(datetime.now(timezone.utc))


def _feed(spark: SparkSession, rows: DataFrame, transport: str = "plait.sources.feeds:fetch") -> DataFrame:
    spark.dataSource.register(FeedSource)
    feeds = [{"source_id": r["id"], "url": r["feed_url"], "alternates": r["alt_feed_urls"]} for r in rows.select("id", "feed_url", "alt_feed_urls").collect()]
    return spark.read.format("plait_feed").option("feeds", json.dumps(feeds)).option("transport", transport).load()


def _tables(spark: SparkSession, root: str, *names: str) -> list[DataFrame] | None:
    """The newest versions of the tables, or None if one was never written."""
    try:
        return [_read(spark, root, name) for name in names]
    except AnalysisException:
        return None


def _synced(spark, args) -> DataFrame:
    """The sources table after a sync with the whole registry: a selection of a command never thins it."""
    listed, old = registry.load_registry(spark, args.sources), _tables(spark, args.root, "sources")
    return registry.sync(old[0], listed) if old else listed.drop(*registry.LOCAL)


def _only(rows: DataFrame, source: str | None) -> DataFrame:
    return rows if source is None else rows.where((F.col("id") == source) | (F.lower("outlet") == source.lower()))


def verify_feeds(spark, args, config):
    """Reads all listed feeds, or one, and the first pages of each; prints and writes the report."""
    listed, now = _only(registry.load_registry(spark, args.sources), args.source), _now(args)
    feed = _feed(spark, listed, args.transport).persist(StorageLevel.DISK_ONLY)  # each feed and page is asked for once; a lost executor asks again
    try:
        fetched = P.fetch_pages(reports.first_entries(feed).where("sampled"), args.page_transport, workers=config.fetch_workers).persist(StorageLevel.DISK_ONLY)
        rows = [r.asDict() for r in reports.audit(listed, feed, fetched, now).orderBy("position").collect()]  # one a feed
        fetched.unpersist()
    finally:
        feed.unpersist()
    text = reports.audit_markdown(rows, args.now or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M UTC"))
    if args.out and not args.dry_run:
        with open(args.out, "w", encoding="utf-8") as out:
            out.write(text + "\n")
    print(text)


def sync_sources(spark, args, config):
    _write(_synced(spark, args), args.root, "sources", args.dry_run)


def ingest_feeds(spark, args, config):
    """Feeds and pages of the selected sources; new rows join the articles table.  A dry run shows three of them."""
    if not args.dry_run:
        sync_sources(spark, args, config)
    listed = registry.select(registry.load_registry(spark, args.sources), args.include_unverified, args.source)
    old = _tables(spark, args.root, "articles")
    known = old[0].select("canonical_url") if old else spark.createDataFrame([], "canonical_url string")
    feed = _feed(spark, listed, args.transport)
    if args.dry_run:
        wanted = ingest.prune(ingest.entries(feed.where("error is null")), listed, known, _now(args), config)
        pages = P.fetch_pages(wanted, args.page_transport, workers=config.fetch_workers).where("error is null").drop("error")
        for r in flow.build_stage(wanted, listed, pages, _now(args), config).select("outcome", "source_id", "title", "canonical_url").limit(3).collect():
            print(json.dumps(r.asDict()))
        return
    feed, pages = _harvested(spark, args, config, feed, listed, known, f"{args.root}/versions")
    built = tables.publish(flow.ingest_stage(listed, feed, pages, known, _now(args), config), f"{args.root}/versions/built-{_stamp()}")
    for r in ingest.stats(built).orderBy("source_id").collect():
        print(json.dumps(r.asDict()))
    rows, counted = tables.publish_counted(flow.new_rows(built, known, listed), f"{args.root}/versions/rows-{_stamp()}", inserted=F.count(F.lit(1)))
    print(json.dumps(counted))
    _write(old[0].unionByName(rows, allowMissingColumns=True) if old else rows, args.root, "articles", False)


def _harvested(spark, args, config, feed: DataFrame, listed: DataFrame, known: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(feed items, pages of the entries that are worth a request), both published, so that nothing is asked for twice; failures are printed."""
    stamp = _stamp()
    feed, counted = tables.publish_counted(feed, f"{root}/feed_items-{stamp}", items=F.count("link"), failed_feeds=F.count("error"))
    wanted = ingest.prune(ingest.entries(feed.where("error is null")), listed, known, _now(args), config)
    pages, more = tables.publish_counted(P.fetch_pages(wanted, args.page_transport, workers=config.fetch_workers), f"{root}/pages-{stamp}", pages=F.count(F.lit(1)), failed_pages=F.count("error"))
    print(json.dumps({"fetched": counted | more}))
    for r in feed.where("error is not null").select("source_id", "error").orderBy("source_id").limit(100).collect():  # a report
        print(json.dumps(r.asDict()))
    return feed.where("error is null"), pages.where("error is null").drop("error")


def enrich_articles(spark, args, config):
    have = _read(spark, args.root, "articles")
    done = enrich.run(enrich.queue(have, args.limit, config), _model(args) or models.OfflineModel, config)
    if args.dry_run:
        _write(done, args.root, "enriched", True)
        return
    done = tables.publish(done, f"{args.root}/versions/enriched-{_stamp()}")
    for r in models.usage(done.select(F.explode("calls").alias("c")).select("c.*")).collect():
        print(json.dumps(r.asDict()))
    _write(flow.replaced(have, done, "id"), args.root, "articles", False)


def _assign(spark, args, config, articles=None, stories=None, limit=None) -> tuple[DataFrame, DataFrame]:
    articles, stories = articles or _read(spark, args.root, "articles"), stories or _read(spark, args.root, "stories")
    config = dataclasses.replace(config, assign_batch=limit) if limit else config
    done = flow.assign_stage(articles, stories, _read(spark, args.root, "sources"), _now(args), _verifier(args), config)
    if args.dry_run:
        counted = assign.stats(done).first().asDict()
    else:
        done, counted = tables.publish_counted(done, f"{args.root}/versions/assigned-{_stamp()}", **assign.counters())
    print(json.dumps({"assign": counted}))
    after = _write(S.close_stale(flow.stories_after(stories, done, _now(args)), _now(args), config), args.root, "stories", args.dry_run)  # before the articles, which point to them
    return _write(flow.assigned(articles, done, _now(args)), args.root, "articles", args.dry_run), after


def assign_articles(spark, args, config):
    _assign(spark, args, config, limit=args.limit)


def _pairs(spark, args, config, hours, stories=None) -> None:
    s, now = stories or _read(spark, args.root, "stories"), _read(spark, args.root, "pairs")
    since = None if args.story else _now(args).cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    some = s.where(F.col("story_id") == args.story) if args.story else s
    def keep(df, name, **counters):
        out, counted = tables.publish_counted(df, f"{args.root}/versions/{name}-{_stamp()}", **counters) if counters else (tables.publish(df, f"{args.root}/versions/{name}-{_stamp()}"), {})
        if counted:
            print(json.dumps({"pairs": counted}))
        return out

    some, after = flow.pair_stage(_read(spark, args.root, "articles"), some, now, since, _model(args), config, None if args.dry_run else keep)
    if args.story:
        some = s.where(F.col("story_id") != args.story).unionByName(some)
    _write(after, args.root, "pairs", args.dry_run)
    if args.model:
        _write(some, args.root, "stories", args.dry_run)


def pair_stories(spark, args, config):
    _pairs(spark, args, config, args.lookback_hours or config.pairs_lookback_hours)
    if not args.dry_run:
        refresh_feed(spark, args, config)


def merge_stories(spark, args, config):
    """Merges are only made with a model that says so."""
    before = [_read(spark, args.root, t) for t in ("articles", "stories", "pairs")]
    *after, stats = flow.merge_stage(*before, _merger(args), _now(args), config)
    print(json.dumps(stats))
    if stats["merged"]:
        for name, df in zip(("articles", "stories", "pairs"), after):
            _write(df, args.root, name, args.dry_run)
        if not args.dry_run:
            refresh_feed(spark, args, config)


def fix_text(spark, args, config):
    have, names = _read(spark, args.root, "articles"), ["title", "headline", "subheadline", "snippet"]
    delta = ingest.changed_text(have, "id", names)
    if args.dry_run:
        _write(delta, args.root, "text_fixes", True)
        return
    given = delta.select("id", *[F.col(c).alias(f"__{c}") for c in names])
    _write(have.join(given, "id", "left").withColumns({c: F.coalesce(f"__{c}", c) for c in names}).select(*have.columns), args.root, "articles", False)


def recheck_stories(spark, args, config):
    """Suspects asked again; then detached articles are filed anew, duplicates merged, pairs of a week maintained and the feed refreshed."""
    make = _model(args) or models.OfflineModel
    counts: dict[str, int] = {}

    def keep(df, name, **counters):
        out, counted = tables.publish_counted(df, f"{args.root}/versions/{name}-{_stamp()}", **counters)
        counts.update(counted)
        return out

    out = flow.recheck_stage(_read(spark, args.root, "articles"), _read(spark, args.root, "stories"), make, _now(args), config, args.limit, keep)
    if args.report:
        tables.write_tsv(out["report"], args.report, ["story_title_before", "published_at"])
    print(json.dumps(counts))
    for r in out["reanchored"].orderBy("story_id").limit(15).collect():
        print(f"{r['before']} -> {r['after']}")
    for r in recheck.histogram(out["decisions"]).orderBy("cut").collect():
        print(f">= {r['cut']:.2f}: {r['n']}")
    for r in recheck.borderline(out["decisions"]).collect():
        print(f"{r['relation']} {r['confidence']:.2f} {r['story_id']} {r['id']}")
    for r in out["report"].where("decision = 'detached'").orderBy("story_id", "article_id").limit(40).collect():
        print(f"{r['relation']} {r['confidence']} {r['story_anchor']} -> {r['outlet']}: {r['headline']}")
    if args.dry_run:
        return
    articles, stories = _write(out["articles"], args.root, "articles", False), _write(out["stories"], args.root, "stories", False)
    _assign(spark, args, config, articles, stories, max(config.assign_batch, counts.get("detached", 0) + 100))
    merge_stories(spark, args, config)
    _pairs(spark, args, config, 24 * 7)
    refresh_feed(spark, args, config)


def backfill_framing(spark, args, config):
    since, have = _now(args) - F.make_dt_interval(days=F.lit(args.days)), _read(spark, args.root, "articles")
    done = enrich.backfill_framing(enrich.framing_queue(have, since, config.framing_cap), _model(args) or models.OfflineModel, config)
    if args.dry_run:
        _write(done, args.root, "framing", True)
        return
    _write(flow.replaced(have, done.select(*have.columns), "id"), args.root, "articles", False)
    refresh_feed(spark, args, config)


def status(spark, args, config):
    for r in reports.status(*(_read(spark, args.root, t) for t in ("articles", "stories", "pairs"))).orderBy("measure").collect():
        print(f"{r['measure']}\t{r['n']}")


def run(spark, args, config):
    """Everything from the feeds to the feed table, from the tables under the root if there are any, each stage published; a dry run stops before any request.
    The whole registry is synced first; feeds are read for the selection only."""
    listed = registry.select(registry.load_registry(spark, args.sources), args.include_unverified, args.source)
    if args.dry_run:
        print(json.dumps({"sources": listed.count(), "dry_run": True}))
        return
    old = _tables(spark, args.root, "articles", "stories", "pairs")
    root = args.root if old is None and _tables(spark, args.root, "sources") is None else f"{args.root}/run-{_stamp()}"
    known_sources = tables.publish(_synced(spark, args), f"{root}/sources")
    known = old[0].select("canonical_url") if old else spark.createDataFrame([], "canonical_url string")
    feed, pages = _harvested(spark, args, config, _feed(spark, listed, args.transport), listed, known, root)
    previous = dict(zip(("articles", "stories", "pairs"), old)) if old else None
    out = flow.run(listed, feed, pages, root, _now(args), make=_model(args) or models.OfflineModel, verifier=_verifier(args), config=config, previous=previous, merger=_merger(args), titler=_model(args), registry=known_sources)
    print(json.dumps({name: df.count() for name, df in out.items()}))


def trim(spark, args, config):
    _write(S.trim_bodies(_read(spark, args.root, "articles"), _now(args), config), args.root, "articles", args.dry_run)


def refresh_feed(spark, args, config):
    _write(S.feed(*(_read(spark, args.root, t) for t in ("stories", "pairs", "articles"))), args.root, "feed", args.dry_run)


COMMANDS = {
    "verify-feeds": verify_feeds, "sync-sources": sync_sources, "ingest": ingest_feeds, "enrich": enrich_articles, "assign": assign_articles, "pairs": pair_stories, "merge": merge_stories,
    "fix-text": fix_text, "recheck-stories": recheck_stories, "backfill-framing": backfill_framing, "run": run, "status": status, "trim": trim, "refresh-feed": refresh_feed,
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="plait", description=__doc__)
    p.add_argument("command", choices=sorted(COMMANDS))
    p.add_argument("--root", default="tables")
    for name in ("--sources", "--source", "--out", "--story", "--report", "--now", "--model"):
        p.add_argument(name)
    for name in ("--limit", "--lookback-hours"):
        p.add_argument(name, type=int)
    p.add_argument("--transport", default="plait.sources.feeds:fetch")
    p.add_argument("--page-transport", default="plait.sources.feeds:open_url")
    p.add_argument("--days", type=int, default=7)
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--include-unverified", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None, config: Config | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("plait").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.master.startswith("local"):
        spark.conf.set("spark.checkpoint.dir", f"{args.root}/scratch")  # the tables' root is a folder that all machines share
    COMMANDS[args.command](spark, args, config or from_environment())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
