"""Streaming jobs over the given tables, run until all input is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.plans.fixtures import as_event_predictions, reviews, sql, table
from opinara.plans.registry import Registry
from opinara.plans.reports import COUNTS_SQL
from opinara.plans.storage import REVIEW_FIELDS, SENT_AT
from opinara.plans.text_models import SCORED_VIEWS, fitted
from opinara.schema import CLASSES, PREDICTION
from opinara.session import work_folder
from opinara.sources.messages import file_stream, parse_messages, send_to_files, to_messages
from opinara.sources.sinks import batch_sink
from opinara.sources.tables import scan_parquet
from opinara.streaming import windows
from opinara.streaming.replay import replay
from opinara.streaming.scoring import start_scoring_store
from opinara.streaming.store import compact_store, scan_store, start_store

QUERIES = Registry()

NOW = {"availableNow": True}
FIELDS = ["helpful", *REVIEW_FIELDS, "sentiment"]


def _messages(spark, sf_dir):
    return to_messages(reviews(spark, sf_dir, *FIELDS), F.lit(SENT_AT))


def _scored(spark, sf_dir, send, runs: int = 1):
    """Run the scoring stream ``runs`` times from one checkpoint; ``send`` provides input before each."""
    paths = {n: work_folder(spark, f"stream-{n}") for n in ("messages", "predictions", "rejects", "checkpoint")}
    model = fitted(spark, sf_dir, "Naive Bayes")
    for run in range(runs):
        send(run, paths)
        stream = file_stream(spark, paths["messages"])
        clock = F.lit(SENT_AT).cast("timestamp")
        where = paths["predictions"], paths["rejects"], paths["checkpoint"]
        for query in start_scoring_store(stream, model, *where, NOW, clock):
            query.awaitTermination()
    return paths


@QUERIES.add(
    "stream_score",
    sql(
        f"""
select asin, "reviewTime", "reviewerID", summary, timestamp '{SENT_AT}' as processed_ts, s.label, s.confidence
from scored s join reviews using (doc_id)
""",
        **SCORED_VIEWS,
    ),
)
def stream_score(spark, sf_dir):
    paths = _scored(spark, sf_dir, lambda run, paths: send_to_files(_messages(spark, sf_dir), paths["messages"]))
    return scan_store(spark, paths["predictions"], PREDICTION).select(
        "asin", "reviewTime", "reviewerID", "summary", F.col("processed_ts").cast("timestamp_ntz").alias("processed_ts"),
        "label", F.round("confidence", 4).alias("confidence")
    )


@QUERIES.add(
    "stream_restart",
    sql(
        """
select asin, count(*) as n, sum(length("reviewText")) as characters, round(sum(s.confidence), 2) as confidence,
  count(*) filter (s.label = 'positive') as positive
from scored s join reviews using (doc_id) group by asin
""",
        **SCORED_VIEWS,
    ),
)
def stream_restart(spark, sf_dir):
    """Half of the reviews, a compaction, a restart, the other half, and a restart with nothing new."""
    copy = work_folder(spark, "compacted")
    df = reviews(spark, sf_dir, "doc_id", *FIELDS)

    def send(run: int, paths: dict[str, str]) -> None:
        if run < 2:
            send_to_files(to_messages(df.filter(F.col("doc_id") % 2 == run), F.lit(SENT_AT)), paths["messages"])
        if run == 1:
            compact_store(spark, paths["predictions"], PREDICTION, copy)

    paths = _scored(spark, sf_dir, send, runs=3)
    return scan_store(spark, paths["predictions"], PREDICTION, copy).groupBy("asin").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("reviewText")).alias("characters"),
        F.round(F.sum(F.round("confidence", 4)), 2).alias("confidence"),
        F.count_if(F.col("label") == "positive").alias("positive"),
    )


BATCHES = 5


@QUERIES.add(
    "stream_replay",
    sql("select count(*) as n, count(distinct asin) as products, true as paced, true as several from reviews"),
)
def stream_replay(spark, sf_dir):
    """All reviews at a pace: files of a fifth of them at most, one per micro-batch."""
    df = reviews(spark, sf_dir, *FIELDS)
    pace = max(1, df.count() // BATCHES)
    out = work_folder(spark, "replayed")
    paced = replay(df, work_folder(spark, "paced"), pace, F.lit(SENT_AT))
    query = parse_messages(paced).writeStream.foreachBatch(batch_sink(out))
    query = query.option("checkpointLocation", work_folder(spark, "replay-checkpoint"))
    query.trigger(availableNow=True).start().awaitTermination()
    done = scan_parquet(spark, out)
    sizes = done.groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"))
    judged = sizes.agg((F.max("rows") <= pace).alias("paced"), (F.count(F.lit(1)) >= BATCHES).alias("several"))
    totals = done.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("asin").alias("products"))
    told = judged.agg(F.first(F.struct("paced", "several"))).scalar()
    return totals.withColumn("_told", told).select("n", "products", "_told.paced", "_told.several")


PARTS = 3
# Times that come first, in the middle and last; the first part holds the newest rows, so the others come late.
ARRIVAL = 2


def _minutes(spark, sf_dir) -> tuple[DataFrame, str]:
    """The live sums over the events, which arrive in several micro-batches and out of order; the late rows' table."""
    events, paths = table(spark, sf_dir, "events"), [work_folder(spark, n) for n in ("events", "minutes", "late", "checkpoint")]
    for part in range(PARTS):
        here = F.pmod(F.dayofmonth("ts"), F.lit(PARTS)) == (ARRIVAL - part) % PARTS
        events.filter(here).write.mode("append").parquet(paths[0])
        stream = as_event_predictions(spark.readStream.schema(events.schema).parquet(paths[0]))
        windows.start_minutes(stream, *paths[1:], **NOW).awaitTermination()
    return windows.current(spark, paths[1]), paths[2]


@QUERIES.add(
    "stream_minute_sentiment",
    sql(f"select date_trunc('minute', processed_ts)::timestamp as minute, {COUNTS_SQL} from event_predictions group by 1"),
)
def stream_minute_sentiment(spark, sf_dir):
    return windows.by_minute(_minutes(spark, sf_dir)[0])


@QUERIES.add(
    "stream_late_rows",
    """
with parts as (
  select case day(ts) % 3 when 2 then 0 when 1 then 1 else 2 end as part, ts from events),
bounds as (select part, (select max(ts) from parts b where b.part < a.part) - interval 1 day as bound from parts a group by part)
select part as batch_id, count(*) filter (where ts < bound) as late_rows, max(ts) as newest
from parts join bounds using (part) group by part
""",
)
def stream_late_rows(spark, sf_dir):
    """How many rows of each micro-batch came more than a day after the newest one before; they are counted all the same."""
    late = scan_parquet(spark, _minutes(spark, sf_dir)[1])
    return late.select(F.col("batch_id").cast("bigint").alias("batch_id"), "late_rows", "newest")


@QUERIES.add(
    "stream_recent_kpi",
    sql(
        f"""
select window_start, window_start + interval 5 minutes as window_end, count(*) as total_reviews, {COUNTS_SQL},
  round(sum(confidence) / count(*), 6) as avg_confidence from sliding group by 1, 2
""",
        sliding="""select label, confidence,
          date_trunc('minute', processed_ts)::timestamp - to_minutes(unnest(range(0, 5))) as window_start
          from event_predictions""",
    ),
)
def stream_recent_kpi(spark, sf_dir):
    out = windows.sliding_headline(_minutes(spark, sf_dir)[0])
    return out.withColumn("avg_confidence", F.round("avg_confidence", 6))


# Events come in thirds of the month; those of every eleventh hour come with the part after, mostly too late.
LATE_VIEWS = {
    "arrival": """select *, (day(processed_ts) * 3) // 32 + case when hour(processed_ts) % 11 = 5 then 1 else 0 end as part
      from event_predictions""",
    "bounds": """select part, (select max(processed_ts) from arrival b where b.part < a.part) - interval 1 hour as bound
      from (select distinct part from arrival) a""",
    "judged": """select arrival.*, date_trunc('minute', processed_ts)::timestamp as minute,
      coalesce(date_trunc('minute', processed_ts)::timestamp + interval 1 minute <= bound, false) as late
      from arrival join bounds using (part)""",
    "closed": "select max(processed_ts) - interval 1 hour as bound from judged",
}
LATENESS = "1 hour"


def _arriving(spark, sf_dir, start) -> dict[str, str]:
    """Events in several parts, one micro-batch each, with a restart before every part; ``start`` makes the query."""
    events = table(spark, sf_dir, "events")
    late = (F.hour("ts") % 11 == 5).cast("int")
    part = F.floor(F.dayofmonth("ts") * 3 / 32) + late
    paths = {n: work_folder(spark, f"live-{n}") for n in ("events", "rows", "bounds", "checkpoint")}
    for i in range(PARTS + 1):
        events.filter(part == i).write.mode("append").parquet(paths["events"])
        stream = as_event_predictions(spark.readStream.schema(events.schema).parquet(paths["events"]))
        query = start(stream, paths)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return paths


@QUERIES.add(
    "stream_closed_minutes",
    sql(
        f"""
select minute, {COUNTS_SQL}, true as bounded
from judged where not late and minute + interval 1 minute <= (select bound from closed) group by minute
""",
        **LATE_VIEWS,
    ),
)
def stream_closed_minutes(spark, sf_dir):
    """Minutes closed by the watermark, each appended once over all restarts; state stays below an hour of them."""
    most = []

    def start(stream, paths):
        found = windows.flat_minutes(windows.closing_minutes(stream, LATENESS))
        query = start_store(found, paths["rows"], paths["checkpoint"], NOW, time=None)
        query.awaitTermination()
        most.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
        return query

    paths = _arriving(spark, sf_dir, start)
    found = scan_parquet(spark, paths["rows"]).select("minute", *reversed(CLASSES))
    return found.withColumn("bounded", F.lit(max(most) <= 61))


@QUERIES.add(
    "stream_closed_headlines",
    sql(
        f"""
select window_start, window_start + interval 5 minutes as window_end, count(*) as total_reviews, {COUNTS_SQL},
  round(sum(confidence) / count(*), 6) as avg_confidence
from sliding where window_start + interval 5 minutes <= (select bound from closed) group by 1, 2
""",
        **LATE_VIEWS,
        sliding="select minute - to_minutes(unnest(range(0, 5))) as window_start, label, confidence from judged where not late",
    ),
)
def stream_closed_headlines(spark, sf_dir):
    """Sliding headlines over closed minutes: two stateful operators in a row."""

    def start(stream, paths):
        return start_store(windows.closing_headlines(stream, LATENESS), paths["rows"], paths["checkpoint"], NOW, time=None)

    found = scan_parquet(spark, _arriving(spark, sf_dir, start)["rows"])
    return found.withColumn("avg_confidence", F.round("avg_confidence", 6))


@QUERIES.add(
    "stream_rows_aside",
    sql(
        """
select processed_ts, user_id, label, round(confidence, 6) as confidence, part::bigint as batch_id,
  count(*) over (partition by part) as observed
from judged where late
""",
        **LATE_VIEWS,
    ),
)
def stream_rows_aside(spark, sf_dir):
    """The late rows themselves, with the number that was observed of their batch."""

    def start(stream, paths):
        return windows.start_late_rows(stream, paths["rows"], paths["bounds"], paths["checkpoint"], LATENESS, **NOW)

    paths = _arriving(spark, sf_dir, start)
    observed = scan_parquet(spark, paths["bounds"]).select("batch_id", F.col("late_rows").alias("observed"))
    found = scan_parquet(spark, paths["rows"]).join(observed, "batch_id")
    batch = F.col("batch_id").cast("bigint").alias("batch_id")
    return found.select("processed_ts", "user_id", "label", F.round("confidence", 6).alias("confidence"), batch, "observed")


@QUERIES.add(
    "dead_letter",
    sql("""
select reason, scored, count(*) as n from (
  select case when doc_id % 25 = 7 then 'malformed' when "reviewText" is null or "reviewText" = '' then 'no text'
    when doc_id % 25 = 8 then 'bad fields: overall' when doc_id % 25 = 9 then 'bad fields: helpful, unixReviewTime' end as reason,
    doc_id % 25 in (8, 9) and "reviewText" <> '' and "reviewText" is not null as scored
  from reviews) where reason is not null group by 1, 2
"""),
)
def dead_letter(spark, sf_dir):
    """Messages cut in half or without text are set aside; fields of a wrong type are noted, and the text is scored."""
    df = reviews(spark, sf_dir, "doc_id", *FIELDS)
    kind = F.col("doc_id") % 25

    def sent(rows: DataFrame) -> DataFrame:
        return to_messages(rows, F.lit(SENT_AT))

    def changed(rows: DataFrame, *changes: tuple[str, str]) -> DataFrame:
        value = F.col("value")
        for pattern, replacement in changes:
            value = F.regexp_replace(value, pattern, replacement)
        return sent(rows).select(value.alias("value"))

    cut = sent(df.filter(kind == 7)).select(F.expr("substring(value, 1, length(value) div 2)").alias("value"))
    parts = [
        sent(df.filter(~kind.isin(7, 8, 9, 10))),
        cut,
        changed(df.filter(kind == 8), (r'"overall":[0-9.]+', '"overall":"many"')),
        changed(df.filter(kind == 9), (r'"helpful":\[[^]]*\]', '"helpful":"both"'), (r'"unixReviewTime":[0-9]+', '"unixReviewTime":{}')),
        # Numbers and votes as text, whole numbers with a point: nothing is lost.
        changed(
            df.filter(kind == 10),
            (r'"overall":([0-9.]+)', '"overall":"$1"'),
            (r'"helpful":(\[[^]]*\])', '"helpful":"$1"'),
            (r'"sentiment":([0-9]+)', '"sentiment":$1.0'),
        ),
    ]
    paths = _scored(spark, sf_dir, lambda run, paths: [send_to_files(p, paths["messages"]) for p in parts])
    return scan_parquet(spark, paths["rejects"]).groupBy("reason", "scored").agg(F.count(F.lit(1)).alias("n"))
