"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or views Spark derives from them) in
full, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window

from ..operators import gold as G
from ..sources import testviews as TV
from ..sources.tables import materialize

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def gold_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table of the silver view: rebuilt and written once per session
    and input folder (SNK-2); questions and profiles read the stored table."""
    return TV.memo_view(spark, "gold", sf_dir, lambda: materialize(
        G.gold_transform(TV.silver(spark, sf_dir), TV.TEST_AS_OF), "gold", wide=True))


@register("gold_transform")
def q_gold_transform(spark, sf_dir):
    return G.gold_transform(TV.silver(spark, sf_dir), TV.TEST_AS_OF)


@register("gold_stats")
def q_gold_stats(spark, sf_dir):
    return G.transform_stats(TV.silver(spark, sf_dir))


# ---------------------------------------------------------------------------
# Car-name parsing and exclusion on their own (FN-1..6, FIL-1).
# ---------------------------------------------------------------------------
from ..functions import names as N  # noqa: E402
from ..operators import lifecycle as LC  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..operators import scd as SCD  # noqa: E402
from ..operators import stats as ST  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from . import pipelines as P  # noqa: E402
from ..schemas import HISTORY, LISTING_COLUMNS, LISTINGS, QUARANTINE, RUN_EVENTS  # noqa: E402
from ..session import scratch_path  # noqa: E402
from ..sources import snapshots as SN  # noqa: E402
import datetime as _dt  # noqa: E402
import uuid  # noqa: E402


def _root(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")

TEST_RUN_TS = _dt.datetime(2002, 7, 1, 6, 0, 0)
TS_TEXT = "yyyy-MM-dd HH:mm:ss"


@register("brand_model_trim")
def q_brand_model_trim(spark, sf_dir):
    s = TV.silver(spark, sf_dir).select("listing_id", "car_name")
    t = N.with_brand_model_trim(s)
    return t.select("listing_id", "_bmt.brand", "_bmt.model", "_bmt.trim")


@register("commercial_filter")
def q_commercial_filter(spark, sf_dir):
    s = G.with_commercial_flag(TV.silver(spark, sf_dir))
    return s.select("listing_id", F.col("_commercial").alias("commercial"))


# ---------------------------------------------------------------------------
# Data quality (VAL-*, SNK-3, AGG-5, TOP-1).
# ---------------------------------------------------------------------------
def _split(spark, sf_dir):
    return Q.validate_split(TV.silver(spark, sf_dir))


def _quarantine(spark, sf_dir):
    _, failures = _split(spark, sf_dir)
    return Q.to_quarantine(failures, 1, TEST_RUN_TS)


@register("validate_clean")
def q_validate_clean(spark, sf_dir):
    recs, _ = _split(spark, sf_dir)
    return recs.withColumn("scraped_at", F.date_format("scraped_at", TS_TEXT))


@register("validate_failures")
def q_validate_failures(spark, sf_dir):
    _, failures = _split(spark, sf_dir)
    return failures


@register("quarantine_stats")
def q_quarantine_stats(spark, sf_dir):
    return Q.quarantine_stats(_quarantine(spark, sf_dir))


@register("quarantine_by_rule")
def q_quarantine_by_rule(spark, sf_dir):
    return Q.quarantine_by_rule(_quarantine(spark, sf_dir))


@register("quarantine_recent")
def q_quarantine_recent(spark, sf_dir):
    r = Q.quarantine_recent(_quarantine(spark, sf_dir), 50)
    return r.withColumn("quarantined_at", F.date_format("quarantined_at", TS_TEXT))


# ---------------------------------------------------------------------------
# Statistics and profile (AGG-1..4, Q16, PIP-5, I-C1).
# ---------------------------------------------------------------------------
@register("listing_counts")
def q_listing_counts(spark, sf_dir):
    return ST.listing_counts(TV.silver(spark, sf_dir))


@register("field_coverage")
def q_field_coverage(spark, sf_dir):
    return ST.field_coverage(TV.silver(spark, sf_dir))


@register("price_stats")
def q_price_stats(spark, sf_dir):
    return ST.price_stats(TV.silver(spark, sf_dir))


@register("profile_counts")
def q_profile_counts(spark, sf_dir):
    return ST.profile_counts(gold_of(spark, sf_dir))


@register("profile_numeric")
def q_profile_numeric(spark, sf_dir):
    return ST.profile_numeric(gold_of(spark, sf_dir))


# ---------------------------------------------------------------------------
# Worklists, discovery, lifecycle (FIL-2/3, SET-1, J-2, J-3).
# ---------------------------------------------------------------------------
@register("worklist_missing")
def q_worklist_missing(spark, sf_dir):
    return LC.worklist_missing(TV.silver(spark, sf_dir))


@register("worklist_active")
def q_worklist_active(spark, sf_dir):
    return LC.worklist_active(TV.silver(spark, sf_dir))


@register("worklist_union")
def q_worklist_union(spark, sf_dir):
    return LC.worklist_union(TV.silver(spark, sf_dir))


def _discovered(spark, sf_dir):
    """Ids found by this run's discovery pages: the line items' order keys."""
    li = TV.read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("listing_id"))


@register("new_only")
def q_new_only(spark, sf_dir):
    # Seen = the listings snapshot taken before 1998.
    seen = TV.silver(spark, sf_dir).where(F.col("scraped_at") < F.lit("1998-01-01").cast("timestamp"))
    return LC.new_only(_discovered(spark, sf_dir), seen)


@register("delist_unseen")
def q_delist_unseen(spark, sf_dir):
    out = LC.delist_unseen(TV.silver(spark, sf_dir), _discovered(spark, sf_dir))
    return out.select("listing_id", "status", F.col("_delisted").alias("delisted"))


# ---------------------------------------------------------------------------
# Merge and SCD-2 over the change feed (MRG-*, SCD-*, AGG-6/8, FIL-7/8).
# ---------------------------------------------------------------------------
FEED_COLS = ["price", "depreciation", "status", "detail_url", "owners"]
FEED_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)


def _run_ts(day_col="day"):
    return F.col(day_col).cast("timestamp") + F.expr("INTERVAL 1 DAY")


def _run_id(day_col="day"):
    return F.date_format(F.col(day_col), "yyyyMMdd").cast("bigint")


@register("batch_last_nonnull")
def q_batch_last_nonnull(spark, sf_dir):
    feed = TV.feed(spark, sf_dir).select("listing_id", "day", "seq", *FEED_COLS)
    b = SCD.collapse_batch(feed, ["listing_id", "day"], "seq")
    return b.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("upsert_coalesce")
def q_upsert_coalesce(spark, sf_dir):
    feed = TV.feed(spark, sf_dir).select("listing_id", "seq", *FEED_COLS)
    inc = SCD.collapse_batch(feed, ["listing_id"], "seq").drop("seq")
    out = SCD.upsert_coalesce(TV.silver(spark, sf_dir), inc, TEST_RUN_TS)
    return out.select("listing_id", *FEED_COLS, F.date_format("scraped_at", TS_TEXT).alias("scraped_at"))


def _replayed(spark, sf_dir):
    feed = TV.feed(spark, sf_dir).select("listing_id", "day", "seq", *FEED_COLS)
    return SCD.scd2_replay(feed, "day", "seq", _run_ts(), _run_id())


def _history(spark, sf_dir):
    return SCD.history_from_replay(_replayed(spark, sf_dir))


def _fmt_history(h):
    return h.select("listing_id", *FEED_COLS,
                    F.date_format("valid_from", TS_TEXT).alias("valid_from"),
                    F.date_format("valid_to", TS_TEXT).alias("valid_to"),
                    "is_current", "scrape_run_id")


@register("scd2_history")
def q_scd2_history(spark, sf_dir):
    return _fmt_history(_history(spark, sf_dir))


@register("scd2_counts")
def q_scd2_counts(spark, sf_dir):
    c = SCD.replay_counts(_replayed(spark, sf_dir), "day")
    return c.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@register("scd2_versions")
def q_scd2_versions(spark, sf_dir):
    feed = TV.feed(spark, sf_dir).select("listing_id", "seq", *FEED_COLS)
    state = SCD.collapse_batch(feed, ["listing_id"], "seq")
    return SCD.versions(state, _history(spark, sf_dir), 2)


#: Keys of a range of the merged tables of these queries: small, so that the feed's 150 keys fill several.
FEED_WIDTH = 40


def _stored_history(spark, sf_dir):
    """The feed's history as stored: current rows by key range, closed rows by month."""
    def build():
        t = P.Tables(_root(spark, "history"), FEED_WIDTH)
        P.store_history(spark, _history(spark, sf_dir), t)
        return t
    return TV.memo_view(spark, "stored_history", sf_dir, build)


@register("recent_changes")
def q_recent_changes(spark, sf_dir):
    # As of the last daily run of the feed's month, 72 hours back.
    return _fmt_history(P.recent_history(spark, _stored_history(spark, sf_dir), FEED_AS_OF, 72))


@register("current_rows")
def q_current_rows(spark, sf_dir):
    t = _stored_history(spark, sf_dir)
    return _fmt_history(SN.read_table(spark, t.root, t.history, HISTORY))


@register("integrity_violations")
def q_integrity_violations(spark, sf_dir):
    """I-C1 over tables with seeded faults, so that each of the checks has rows:
    keys divisible by 501 twice in gold, by 701 without brand, by 901 with a
    foreign status; in the history, keys divisible by 7 keep their closed rows
    open, by 11 lose their second version, by 13 have no listing."""
    k = F.col("listing_id")
    gold = gold_of(spark, sf_dir).withColumns({
        "brand": F.when(k % 701 != 0, F.col("brand")),
        "status": F.when(k % 901 == 0, F.lit("Lost")).otherwise(F.col("status"))})
    gold = gold.unionByName(gold.where(k % 501 == 0))
    feed = TV.feed(spark, sf_dir).select("listing_id", "seq", *FEED_COLS)
    state = SCD.collapse_batch(feed, ["listing_id"], "seq").where(k % 13 != 0)
    rank = F.row_number().over(Window.partitionBy("listing_id").orderBy("valid_from"))
    history = _history(spark, sf_dir).withColumn("_rank", rank).where((k % 11 != 0) | (F.col("_rank") != 2))
    history = materialize(history.withColumn("is_current", F.col("is_current") | (k % 7 == 0)).drop("_rank"), "seeded")
    return ST.gold_violations(gold).unionByName(ST.history_violations(history, state))


@register("change_details")
def q_change_details(spark, sf_dir):
    """SCD-1: what the feed's last value changes on each known listing."""
    feed = TV.feed(spark, sf_dir).select("listing_id", "seq", *FEED_COLS)
    inc = SCD.collapse_batch(feed, ["listing_id"], "seq")
    cur = TV.silver(spark, sf_dir).select("listing_id", *[F.col(c).alias(f"cur_{c}") for c in FEED_COLS])
    tracked = ["price", "depreciation", "status"]
    both = inc.join(cur, "listing_id")
    found = SCD.changes({c: F.col(f"cur_{c}") for c in tracked}, {c: F.col(c) for c in tracked}, tracked)
    return both.select("listing_id", F.explode(found).alias("c")).select(
        "listing_id", "c.field", F.col("c.old").alias("old_value"), F.col("c.new").alias("new_value"))


@register("record_validity")
def q_record_validity(spark, sf_dir):
    """VAL-11: whether each listing passes every rule."""
    rows = TV.silver(spark, sf_dir).withColumn("key", F.col("listing_id"))     # validating blanks a bad key
    return Q.validate(rows).select(F.col("key").alias("listing_id"), Q.is_valid().alias("is_valid"))


@register("worklist_limited")
def q_worklist_limited(spark, sf_dir):
    """TOP-2: the first 500 entries of the work list."""
    return LC.worklist_union(TV.silver(spark, sf_dir), 500)


@register("history_slice")
def q_history_slice(spark, sf_dir):
    """WIN-5 / TOP-5: the first five versions of the key with the smallest id."""
    t = _stored_history(spark, sf_dir)
    key = P.full_history(spark, t).agg(F.min("listing_id")).first()[0]
    out = P.key_history(spark, t, key, 5)
    return out.select("listing_id", "version", *FEED_COLS, F.date_format("valid_from", TS_TEXT).alias("valid_from"))


# ---------------------------------------------------------------------------
# SQL-gate audit and model-log jobs (GTE-*, LLM-*, AGG-9).
# ---------------------------------------------------------------------------
from ..operators import audit as AU  # noqa: E402


@register("sql_audit")
def q_sql_audit(spark, sf_dir):
    g = AU.sql_gate(TV.sql_texts(spark, sf_dir))
    return g.select("query_id", "passed", "reason", "cleaned_sql")


@register("sql_audit_summary")
def q_sql_audit_summary(spark, sf_dir):
    g = AU.sql_gate(TV.sql_texts(spark, sf_dir))
    return g.groupBy(AU.reason_class(F.col("reason")).alias("reason_class")) \
        .agg(F.count(F.lit(1)).alias("n"))


@register("sql_from_response")
def q_sql_from_response(spark, sf_dir):
    r = TV.responses(spark, sf_dir)
    return r.select("response_id", AU.extract_sql(F.col("text")).alias("sql"))


@register("verdict_class")
def q_verdict_class(spark, sf_dir):
    r = AU.parse_review(TV.reviews(spark, sf_dir))
    return r.select("response_id", "approved", "review_reason", "category")


@register("session_outcome")
def q_session_outcome(spark, sf_dir):
    return AU.session_outcome(TV.attempts(spark, sf_dir))


@register("trace_rollup")
def q_trace_rollup(spark, sf_dir):
    return AU.trace_rollup(TV.trace_steps(spark, sf_dir))


@register("trace_rollup_by_step")
def q_trace_rollup_by_step(spark, sf_dir):
    return AU.trace_rollup(TV.trace_steps(spark, sf_dir), by_step=True)


# ---------------------------------------------------------------------------
# Guarded query surface over the gold table (QRY-1, Q1..Q16).
# ---------------------------------------------------------------------------
from . import query as QRY  # noqa: E402


def _question(name):
    def run(spark, sf_dir):
        return QRY.answer(spark, gold_of(spark, sf_dir), name)
    run.__name__ = f"q_{name}"
    return run


for _name in QRY.QUESTIONS:
    register(_name)(_question(_name))


@register("bounded_results")
def q_bounded_results(spark, sf_dir):
    """TOP-7: what a caller of the guarded surface is told about each statement."""
    return QRY.bounded_report(spark, gold_of(spark, sf_dir))


# ---------------------------------------------------------------------------
# Bronze pages (SCR-*).  The driver's pages carry no payload chunks, so the
# payload parser runs on pages that Spark derives from ``orders``.
# ---------------------------------------------------------------------------
from ..sources import pages as PG  # noqa: E402

LISTING_HOST = "www.example.com"


@register("page_titles")
def q_page_titles(spark, sf_dir):
    return PG.page_titles(TV.read_table(spark, sf_dir, "pages"))


@register("page_links_first")
def q_page_links_first(spark, sf_dir):
    return PG.first_links(TV.read_table(spark, sf_dir, "pages"))


@register("page_scripts")
def q_page_scripts(spark, sf_dir):
    return PG.page_scripts(TV.read_table(spark, sf_dir, "pages"))


@register("rsc_detail")
def q_rsc_detail(spark, sf_dir):
    """SCR-1..13 + the work-list key: records of the fetched detail pages."""
    work = LC.worklist_union(TV.silver(spark, sf_dir))
    return PG.detail_records(TV.payload_detail_pages(spark, sf_dir), work)


@register("rsc_listing_links")
def q_rsc_listing_links(spark, sf_dir):
    return PG.discover_links(TV.payload_listing_pages(spark, sf_dir), LISTING_HOST)


@register("detail_quarantine")
def q_detail_quarantine(spark, sf_dir):
    """VAL-9: failures of the fetched records, out-of-range integers included."""
    _, failures = Q.validate_split(q_rsc_detail(spark, sf_dir))
    return failures


# ---------------------------------------------------------------------------
# Streaming ingest (STR-*): the feed written as one file per day, streamed in
# micro-batches through the SCD-2 step; the result is the final listings state.
# ---------------------------------------------------------------------------
FILES_PER_DAY = 2


def _next_midnight(batch):
    return _dt.datetime.combine(batch.agg(F.max("day")).first()[0], _dt.time()) + _dt.timedelta(days=1)


def _streamed(spark, sf_dir, days_per_trigger=3):
    """Tables after streaming the feed, written day after day, through the validated SCD-2 step."""
    from ..streaming.ingest import ingest_stream

    def build():
        base = _root(spark, "stream")
        feed = materialize(TV.feed(spark, sf_dir).select("listing_id", "day", "seq", *FEED_COLS), "feed")
        src = f"{base}/source"
        # The file source takes files by modification time: one day after another.
        for day in [r[0] for r in feed.select("day").distinct().orderBy("day").collect()]:
            feed.where(F.col("day") == F.lit(day)).repartition(FILES_PER_DAY).write.mode("append").parquet(src)
        ingest_stream(spark, src, feed.schema, f"{base}/tables", f"{base}/checkpoint", "seq", _next_midnight,
                      max_files_per_trigger=days_per_trigger * FILES_PER_DAY, width=FEED_WIDTH).awaitTermination()
        return P.Tables(f"{base}/tables", FEED_WIDTH)
    return TV.memo_view(spark, f"streamed-{days_per_trigger}", sf_dir, build)


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """STR-1: listings after ten micro-batches of three days."""
    t = _streamed(spark, sf_dir)
    return SN.read_table(spark, t.root, t.listings, LISTINGS).select("listing_id", *FEED_COLS)


@register("stream_history")
def q_stream_history(spark, sf_dir):
    """STR-3: the history that those micro-batches leave."""
    return _fmt_history(P.full_history(spark, _streamed(spark, sf_dir)))


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """VAL-9 on the stream: what the micro-batches quarantined, with ids that go on from batch to batch."""
    t = _streamed(spark, sf_dir)
    return SN.read_appended(spark, t.root, t.quarantine, QUARANTINE).select(
        "quarantine_id", "listing_id", "field_name", "field_value", "rule_name", "reason",
        F.date_format("quarantined_at", TS_TEXT).alias("quarantined_at"), "scrape_run_id", "resolved")


DISCOVERY_WRITES = 7
#: Keys of a range where the listings of ``orders`` are merged.
LISTING_WIDTH = 4000


@register("stream_discovery")
def q_stream_discovery(spark, sf_dir):
    """STR-2 / SRC-5: listing pages streamed through the discovery; the anti join keeps the
    first link of an id that later micro-batches bring again."""
    from ..streaming.ingest import discovery_stream
    base = _root(spark, "discovery")
    pages = materialize(TV.payload_listing_pages(spark, sf_dir), "listing-pages")
    # Later pages come in later files: their cards of the same ids carry other links.
    last = pages.agg(F.max("page_id")).first()[0]
    for part in range(DISCOVERY_WRITES):
        some = F.floor(F.col("page_id") * DISCOVERY_WRITES / F.lit((last or 0) + 1)) == part
        pages.where(some).repartition(1).write.mode("append").parquet(f"{base}/source")
    discovery_stream(spark, f"{base}/source", f"{base}/tables", f"{base}/checkpoint", LISTING_HOST, TEST_RUN_TS,
                     max_files_per_trigger=2, width=LISTING_WIDTH).awaitTermination()
    return SN.read_table(spark, f"{base}/tables", "listings", LISTINGS).select("listing_id", "detail_url")


APPLY_WEEK = 7


def _weekly_feed(spark, sf_dir):
    """The feed with its 7-day batch number; four or five batches."""
    feed = TV.feed(spark, sf_dir).select("listing_id", "day", "seq", *FEED_COLS)
    return feed.withColumn("batch", F.floor(F.date_diff("day", F.lit("2024-01-01").cast("date")) / APPLY_WEEK))


@register("scd2_apply_history")
def q_scd2_apply_history(spark, sf_dir):
    """SCD-2 batch by batch through the committed tables (J-4, SCD-2..4, PIP-2):
    the history after every 7-day batch, equal to the replay over those batches."""
    from ..streaming.ingest import make_batch_step

    feed = materialize(_weekly_feed(spark, sf_dir), "weekly-feed")
    root = _root(spark, "apply")
    for n in [r[0] for r in feed.select("batch").distinct().orderBy("batch").collect()]:
        at = _dt.datetime(2024, 1, 1) + _dt.timedelta(days=APPLY_WEEK * (int(n) + 1))
        make_batch_step(root, "seq", at, run_id_base=0, width=FEED_WIDTH)(feed.where(F.col("batch") == n), int(n))
    return _fmt_history(P.full_history(spark, P.Tables(root, FEED_WIDTH)))


@register("value_score")
def q_value_score(spark, sf_dir):
    """WIN-1/WIN-2 alone: scores of the Available consumer listings, attached
    the way the pipeline does (size-checked broadcast of the rank table)."""
    gold = G.project_gold(G.tag_silver(TV.silver(spark, sf_dir)), TV.TEST_AS_OF)
    scored = G.with_value_score(gold)
    return scored.where(F.col("status") == "Available").select("listing_id", "value_score")


@register("token_usage")
def q_token_usage(spark, sf_dir):
    """LLM-4 over every logged step: usage JSON -> canonical token counts (0 when absent)."""
    s = TV.trace_steps(spark, sf_dir)
    u = AU.token_usage(F.col("usage_metadata"))
    return s.select("trace_id", "step", u["prompt_tokens"].alias("prompt_tokens"),
                    u["completion_tokens"].alias("completion_tokens"), u["total_tokens"].alias("total_tokens"))


@register("worklist_fetch_urls")
def q_worklist_fetch_urls(spark, sf_dir):
    """SET-1 + SCR-14: the fetch list with absolute URLs."""
    w = LC.worklist_union(TV.silver(spark, sf_dir))
    return w.select("listing_id", LC.absolute_url(F.col("detail_url")).alias("url"), "priority")


# ---------------------------------------------------------------------------
# Storage and ledger operators (SNK-1, SNK-4, WIN-3, LIF-2, PIP-2, PIP-5).
# ---------------------------------------------------------------------------
@register("export_listings")
def q_export_listings(spark, sf_dir):
    """SNK-1: the exported Parquet file, read back."""
    path = _root(spark, "export")
    SN.export_parquet(TV.silver(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("ingest_listings")
def q_ingest_listings(spark, sf_dir):
    """PIP-2 / VAL-9: listings after validating and ingesting the whole silver view."""
    t = P.Tables(_root(spark, "ingest"), LISTING_WIDTH)
    P.ingest_batch(spark, TV.silver(spark, sf_dir).drop("scraped_at"), t, 1, TEST_RUN_TS)
    return SN.read_table(spark, t.root, t.listings, LISTINGS).select(*LISTING_COLUMNS)


def _run_events(spark, sf_dir):
    """Ledger: one run per day of the feed; the last one is still running."""
    day = TV.feed(spark, sf_dir).groupBy("day").agg(
        F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").cast("int").alias("n"),
        F.count_distinct("listing_id").cast("int").alias("k"))
    none_ts, none_int = F.lit(None).cast("timestamp"), F.lit(None).cast("int")
    run = _run_id().alias("run_id")
    begun = day.select(run, F.col("a").alias("event_ts"), F.col("a").alias("started_at"), none_ts.alias("finished_at"),
                       none_int.alias("pages_fetched"), none_int.alias("listings_count"), F.lit("running").alias("status"))
    done = day.where(F.col("day") < F.lit("2024-01-30").cast("date")).select(
        run, F.col("b").alias("event_ts"), none_ts.alias("started_at"), F.col("b").alias("finished_at"),
        F.col("n").alias("pages_fetched"), F.col("k").alias("listings_count"), F.lit("completed").alias("status"))
    return begun.unionByName(done)


@register("run_states")
def q_run_states(spark, sf_dir):
    """SNK-4: the ledger appended as commits and read back, latest state per run."""
    root = _root(spark, "ledger")
    SN.append_table(_run_events(spark, sf_dir), root, "run_events")
    st = SN.run_state(SN.read_appended(spark, root, "run_events", RUN_EVENTS))
    return st.select("run_id", F.date_format("started_at", TS_TEXT).alias("started_at"),
                     F.date_format("finished_at", TS_TEXT).alias("finished_at"), "pages_fetched", "listings_count", "status")


@register("last_run")
def q_last_run(spark, sf_dir):
    return SN.last_run(_run_events(spark, sf_dir)).select("run_id", "pages_fetched", "status")


@register("resume_page")
def q_resume_page(spark, sf_dir):
    """LIF-2 over the completed runs."""
    return SN.resume_page(_run_events(spark, sf_dir).where(F.col("run_id") < 20240130))


@register("stats_report")
def q_stats_report(spark, sf_dir):
    return ST.stats_report(TV.silver(spark, sf_dir))


# ---------------------------------------------------------------------------
# Quarantine life, mixed schemas, discovery and the daily run (SNK-3, SNK-5, PIP-3, PIP-4).
# ---------------------------------------------------------------------------
@register("quarantine_resolved")
def q_quarantine_resolved(spark, sf_dir):
    """SNK-3 / FIL-6: silver ingested in two commits (odd keys, then even ones); the rows of two rules are
    resolved, and those of one of them opened again."""
    t = P.Tables(_root(spark, "quarantine"), LISTING_WIDTH)
    silver = TV.silver(spark, sf_dir).drop("scraped_at")
    for run, rest in ((1, 1), (2, 0)):
        P.ingest_batch(spark, silver.where(F.col("listing_id") % 2 == rest), t, run, TEST_RUN_TS, track_history=False)
    rows = SN.read_appended(spark, t.root, t.quarantine, QUARANTINE)
    both, again = rows.where(F.col("rule_name").isin("price_range", "fuel_type_enum")), rows.where("rule_name = 'price_range'")
    P.resolve_quarantine(spark, t, both, TEST_RUN_TS + _dt.timedelta(hours=1))
    P.resolve_quarantine(spark, t, again, TEST_RUN_TS + _dt.timedelta(hours=2), resolved=False)
    return P.quarantine_state(spark, t).select("quarantine_id", "listing_id", "field_name", "field_value", "rule_name",
                                               "reason", "scrape_run_id", "resolved")


@register("schema_migration")
def q_schema_migration(spark, sf_dir):
    """SNK-5: even keys in an old commit of 14 columns with narrow integers, odd keys in a
    new one of 28; one read gives both."""
    root, silver, even = _root(spark, "migration"), TV.silver(spark, sf_dir), F.col("listing_id") % 2 == 0
    old = silver.where(even).select(*LISTING_COLUMNS[:14]).withColumns(
        {c: F.col(c).cast("int") for c in ("listing_id", "price", "mileage_km")})
    SN.append_table(old, root, "listings")
    SN.append_table(silver.where(~even).select(*LISTING_COLUMNS), root, "listings")
    return SN.read_appended(spark, root, "listings", LISTINGS).drop("scraped_at")


def _preloaded(spark, sf_dir, name):
    """Tables that hold two thirds of the silver listings, and for every 50th key a listing
    (key + 50,000,000) that the site no longer has."""
    t = P.Tables(_root(spark, name), LISTING_WIDTH)
    k, silver = F.col("listing_id"), TV.silver(spark, sf_dir)
    gone = silver.where(k % 50 == 0).withColumn("listing_id", k + 50_000_000).withColumn(
        "detail_url", F.concat(F.lit("/used-cars/info/gone-"), k.cast("string")))
    state = SN.conform(silver.where(k % 3 != 0).unionByName(gone), LISTINGS)
    step = SN.Commit(spark, t.root)
    step.merge(state, t.listings, "listing_id", t.width, SN.touched_ranges(state, "listing_id", t.width))
    step.finish()
    return t


@register("discover_listings")
def q_discover_listings(spark, sf_dir):
    """PIP-3: the listings after a complete discovery: new ids with the first link, unseen active ones delisted."""
    t = _preloaded(spark, sf_dir, "discover")
    P.discover_batch(spark, TV.payload_listing_pages(spark, sf_dir), t, LISTING_HOST, TEST_RUN_TS, complete=True)
    out = SN.read_table(spark, t.root, t.listings, LISTINGS)
    return out.select("listing_id", "detail_url", "status", "price", F.date_format("scraped_at", TS_TEXT).alias("scraped_at"))


@register("daily_run")
def q_daily_run(spark, sf_dir):
    """PIP-4: a daily run with a phase that fails; one row per phase and count."""
    t = _preloaded(spark, sf_dir, "daily")

    def broken():
        raise RuntimeError("no connection")
    out = P.run_daily(spark, t, TV.payload_listing_pages(spark, sf_dir), TV.payload_detail_pages(spark, sf_dir),
                      LISTING_HOST, TEST_RUN_TS, 7, complete_crawl=True, more=[("export", broken)])
    run_status = SN.run_state(SN.read_appended(spark, t.root, t.runs, RUN_EVENTS)).first()["status"]
    return out.select("phase_no", "phase", "status", "error", F.explode_outer("counts").alias("metric", "value"),
                      F.lit(run_status).alias("run_status"))
