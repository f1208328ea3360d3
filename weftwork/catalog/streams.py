"""Streams over the events table, run until all of it is read."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weftwork.catalog import Tables, query
from weftwork.operators.aggregate import top_per_group
from weftwork.session import scratch_path
from weftwork.streaming import commits, joins, panes, sinks, sources, windows
from weftwork.streaming.sinks import run_in_steps, run_to_table


def _events(t: Tables):
    stream = sources.file_stream(t.spark, t.folder, t.events.schema, "parquet", glob="events.parquet")
    return windows.event_time(stream, "ts")


def _bounds(size: int, slide: int | None = None, keys: str = "") -> str:
    """Event rows with the windows they fall into; sizes are in seconds."""
    slide = slide or size
    step = slide * 1_000_000
    return f"""(SELECT events.*, make_timestamp((epoch_us(ts) // {step} - k) * {step}) AS "start",
  make_timestamp((epoch_us(ts) // {step} - k) * {step} + {size * 1_000_000}) AS "end"
FROM events, range({-(-size // slide)}) r(k) WHERE epoch_us(ts) % {step} + k * {step} < {size * 1_000_000})"""


_DAY, _HOUR = 86_400, 3_600


@query("SELECT event_id, event_type, value FROM events")
def stream_file_scan(t: Tables):
    folder = scratch_path(t.spark, "arrivals")
    t.events.select("event_id", "event_type", "value").repartition(4).write.json(folder)
    stream = sources.file_stream(
        t.spark, folder, "event_id bigint, event_type string, value double", "json", files_per_batch=2
    )
    return run_to_table(stream)


@query("SELECT event_id, upper(event_type) AS kind, value * 2 AS twice FROM events WHERE value > 100")
def stream_filter_map(t: Tables):
    return run_to_table(
        _events(t).where("value > 100").select(
            "event_id", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("twice")
        )
    )


@query("""
SELECT event_id, unnest([event_type, props]) AS word FROM events""")
def stream_explode(t: Tables):
    lines = _events(t).select("event_id", F.concat_ws("|", "event_type", "props").alias("value"))
    return run_to_table(lines.select("event_id", F.explode(F.split("value", "\\|")).alias("word")))


@query("""
SELECT count(*) AS n, CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) AS total, max(value) AS largest FROM events""")
def stream_global_agg(t: Tables):
    totals = _events(t).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"),
        F.max("value").alias("largest"),
    )
    return run_to_table(totals, "complete")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_group_count(t: Tables):
    return run_to_table(_events(t).groupBy("event_type").agg(F.count("*").alias("n")), "complete")


@query("SELECT CAST(0 AS INTEGER) AS batch, event_type, count(*) AS n FROM events GROUP BY 2")
def stream_per_batch_count(t: Tables):
    """Counts within each batch, tagged with its number; no state is kept from batch to batch."""
    out = scratch_path(t.spark, "per-batch")
    save = sinks.batch_files(out, "parquet")

    def write(batch, batch_id):
        save(batch.groupBy("event_type").agg(F.count("*").alias("n")), batch_id)

    sinks.start_batches(_events(t), write, scratch_path(t.spark, "checkpoint")).awaitTermination()
    return sinks.read_batches(t.spark, out, "event_type string, n bigint, batch int", "parquet")


_TOTAL = "CAST(sum(CAST(value AS DECIMAL(28,2))) AS DOUBLE) AS total"


def _total():
    return F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")


@query(f"""
SELECT "start", "end", event_type, {_TOTAL} FROM {_bounds(_DAY)} GROUP BY 1, 2, 3""")
def stream_tumbling(t: Tables):
    sums = windows.windowed(_events(t), "ts", "1 day", [_total()], keys=["event_type"])
    return run_to_table(sums, "complete")


@query(f"""
SELECT "start", "end", event_type, {_TOTAL} FROM {_bounds(_DAY, _HOUR)} GROUP BY 1, 2, 3""")
def stream_sliding(t: Tables):
    sums = windows.windowed(_events(t), "ts", "1 day", [_total()], "1 hour", ["event_type"])
    return run_to_table(sums, "complete")


@query(f"""
SELECT "start", "end", {_TOTAL} FROM {_bounds(_DAY, _HOUR)} GROUP BY 1, 2""")
def stream_sliding_total(t: Tables):
    return run_to_table(windows.windowed(_events(t), "ts", "1 day", [_total()], "1 hour"), "complete")


@query()
def stream_processing_time(t: Tables):
    return run_to_table(windows.by_processing_time(_events(t), "10 seconds", "props"), "complete")


@query("SELECT CAST(sum(length(props)) AS BIGINT) AS characters, CAST(10 AS BIGINT) AS shortest, CAST(10 AS BIGINT) AS longest FROM events")
def stream_processing_time_total(t: Tables):
    """Characters over all windows of the clock, whichever they were, and the length of these windows."""
    found = run_to_table(windows.by_processing_time(_events(t), "10 seconds", "props"), "complete")
    length = F.timestamp_diff("SECOND", F.col("start"), F.col("end"))
    return found.agg(F.sum("characters").alias("characters"), F.min(length).alias("shortest"), F.max(length).alias("longest"))


@query(f"""
SELECT "start", "end", event_type AS color, count(*) AS n FROM {_bounds(2)}
WHERE "end" <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 SECONDS FROM events) GROUP BY 1, 2, 3""")
def stream_watermark_append(t: Tables):
    """A window is written once, when the watermark has passed its end; later windows stay open."""
    colours = _events(t).select("ts", F.col("event_type").alias("color"))
    counts = windows.windowed(
        colours, "ts", "2 seconds", [F.count("*").alias("n")], keys=["color"], late="2 seconds"
    )
    return run_to_table(counts)


@query("SELECT event_id, user_id, c_name FROM events JOIN customer ON user_id = c_custkey")
def stream_static_join(t: Tables):
    named = joins.stream_table_join(_events(t), t.customer, F.expr("user_id = c_custkey"))
    return run_to_table(named.select("event_id", "user_id", "c_name"))


@query("""
SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id
FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 6 HOURS
WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def stream_stream_join(t: Tables):
    def side(kind: str, name: str):
        return _events(t).where(F.col("event_type") == kind).select(
            F.col("event_id").alias(f"{name}_id"), "user_id", F.col("ts").alias(f"{name}_ts")
        )

    pairs = joins.stream_stream_join(
        side("click", "click"), side("purchase", "purchase"), "user_id", "click_ts", "purchase_ts",
        within="6 HOURS", late="1 hour",
    )
    return run_to_table(pairs.select("click_id", "purchase_id", "user_id"))


@query(f"""
SELECT "start", "end", count(*) AS n FROM {_bounds(_HOUR, 900)} GROUP BY 1, 2""")
def stream_window_count(t: Tables):
    counts = windows.windowed(_events(t), "ts", "60 minutes", [F.count("*").alias("n")], "15 minutes")
    return run_to_table(counts, "complete")


@query(f"""
SELECT "start", "end", CAST(sum(length(props)) AS BIGINT) AS chars FROM {_bounds(_HOUR)} GROUP BY 1, 2""")
def stream_window_sum_len(t: Tables):
    sums = windows.windowed(_events(t), "ts", "60 minutes", [F.sum(F.length("props")).alias("chars")])
    return run_to_table(sums, "complete")


@query(f"""
SELECT "start", "end", event_type AS word, count(*) AS n FROM {_bounds(60, 30)} GROUP BY 1, 2, 3""")
def stream_window_word_count(t: Tables):
    said = sources.words(_events(t), "event_type", keep=("ts",))
    counts = windows.windowed(said, "ts", "60 seconds", [F.count("*").alias("n")], "30 seconds", ["word"])
    return run_to_table(counts, "complete")


@query(f"""
SELECT "start", "end", CAST(2 * count(*) AS BIGINT) AS money FROM {_bounds(30, 10)}
WHERE length(event_type) >= 6 GROUP BY 1, 2""")
def stream_money(t: Tables):
    said = sources.words(_events(t), "event_type", keep=("ts",))
    return run_to_table(windows.word_value(said, "ts", "word", "30 seconds", "10 seconds", min_length=6), "complete")


@query("SELECT event_id, event_type, value FROM events")
def stream_foreach_batch(t: Tables):
    """Every batch in its own numbered folder of JSON files."""
    out = scratch_path(t.spark, "batches")
    stream = _events(t).select("event_id", "event_type", "value")
    sinks.start_batches(stream, sinks.batch_files(out), scratch_path(t.spark, "checkpoint")).awaitTermination()
    written = sinks.read_batches(t.spark, out, "event_id bigint, event_type string, value double, batch int")
    return written.drop("batch")


@query("""
SELECT upper(p_name) AS key, '{"p_partkey":' || p_partkey || ',"p_size":' || p_size || '}' AS value FROM part""")
def kv_payload(t: Tables):
    return sinks.to_key_value(t.part, "p_name", "p_partkey", "p_size")


@query(f"""
SELECT "start", "end", CAST(sum(length(props)) AS DOUBLE) / count(*) AS mean_length FROM {_bounds(5)} GROUP BY 1, 2""")
def stream_avg_len(t: Tables):
    return run_to_table(windows.mean_length(_events(t), "ts", "props"), "complete")


@query(f"""
SELECT "start", "end", '#' || event_type AS tag, count(*) AS n FROM {_bounds(60, 10)} GROUP BY 1, 2, 3""")
def windowed_top_tags(t: Tables):
    posts = _events(t).select("ts", F.concat(F.lit("about #"), "event_type", F.lit(" and more")).alias("text"))
    return windows.most_used_first(run_to_table(windows.hashtag_counts(posts, "ts", "text"), "complete"))


@query("""
SELECT "start", tag, n FROM (
  SELECT *, row_number() OVER (PARTITION BY "start" ORDER BY n DESC, tag) AS rn FROM (
    SELECT make_timestamp(epoch_us(ts) // 3600000000 * 3600000000) AS "start", '#' || event_type AS tag, count(*) AS n
    FROM events GROUP BY 1, 2))
WHERE rn = 1""")
def windowed_best_tag(t: Tables):
    """The hashtag used most in each hour."""
    posts = _events(t).select("ts", F.concat(F.lit("#"), "event_type").alias("text"))
    counts = run_to_table(windows.hashtag_counts(posts, "ts", "text", "60 minutes", "60 minutes"), "complete")
    return top_per_group(counts, "start", "tag", "n")


# Windows that are closed by a watermark: written once, in append mode, and only those that can get no further row.


def _closed(late: int, seen: str = "true") -> str:
    """The watermark is that of the rows that reach the windows."""
    return f""""end" <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL {late} SECONDS FROM events WHERE {seen})"""


def _slices(t: Tables, count: int = 4):
    """The events in slices of about equal size, in the order of time, as a stream brings them."""
    events, at = windows.event_time(t.events, "ts"), F.unix_micros("ts")
    cuts = events.agg(F.percentile_approx(at, [i / count for i in range(1, count)])).first()[0] or []
    ends = [None, *cuts, None]
    return [
        events.where((F.lit(True) if a is None else at > a) & (F.lit(True) if b is None else at <= b))
        for a, b in zip(ends, ends[1:])
    ]


def _in_steps(t: Tables, build):
    return run_in_steps(build, _slices(t))[0]


def _cents():
    return panes.summed("total", F.col("value").cast("decimal(18,2)"), lambda total: F.col(total).cast("double"))


@query(f"""
SELECT "start", "end", event_type, {_TOTAL}, count(*) AS n, CAST(sum(user_id) AS DOUBLE) / count(*) AS mean_user, max(value) AS top
FROM {_bounds(_DAY, _HOUR)} WHERE {_closed(_HOUR)} GROUP BY 1, 2, 3""")
def pane_sliding(t: Tables):
    """A day by an hour: each event is counted in one pane of an hour."""
    measures = [_cents(), panes.counted("n"), panes.mean("mean_user", "user_id"), panes.largest("top", "value")]
    return _in_steps(t, lambda rows: panes.sliding(rows, "ts", "1 day", "1 hour", measures, ["event_type"], "1 hour"))


@query(f"""
SELECT "start", "end", count(*) AS n FROM {_bounds(_HOUR, 900)} WHERE {_closed(600)} GROUP BY 1, 2""")
def pane_window_count(t: Tables):
    return _in_steps(
        t, lambda rows: panes.sliding(rows, "ts", "60 minutes", "15 minutes", [panes.counted("n")], late="10 minutes")
    )


@query(f"""
SELECT "start", "end", event_type AS word, count(*) AS n FROM {_bounds(60, 30)} WHERE {_closed(30)} GROUP BY 1, 2, 3""")
def pane_word_count(t: Tables):
    def build(rows):
        said = sources.words(rows, "event_type", keep=("ts",))
        return panes.sliding(said, "ts", "60 seconds", "30 seconds", [panes.counted("n")], ["word"], "30 seconds")

    return _in_steps(t, build)


@query(f"""
SELECT "start", "end", CAST(2 * count(*) AS BIGINT) AS money FROM {_bounds(45, 30)}
WHERE length(event_type) >= 6 AND {_closed(30, "length(event_type) >= 6")} GROUP BY 1, 2""")
def pane_money(t: Tables):
    """45 seconds by 30: the slide does not divide the window, so panes are 15 seconds long."""
    def build(rows):
        long_words = sources.words(rows, "event_type", keep=("ts",)).where(F.length("word") >= 6)
        return panes.sliding(long_words, "ts", "45 seconds", "30 seconds", [panes.summed("money", F.lit(2))], late="30 seconds")

    return _in_steps(t, build)


@query(f"""
SELECT "start", "end", '#' || event_type AS tag, count(*) AS n FROM {_bounds(60, 10)} WHERE {_closed(10)} GROUP BY 1, 2, 3""")
def pane_top_tags(t: Tables):
    """Uses of each hashtag over 60 seconds by 10, most used first."""
    def build(rows):
        posts = rows.select("ts", F.concat(F.lit("about #"), "event_type", F.lit(" and more")).alias("text"))
        tags = posts.select("ts", F.explode(F.split("text", " ")).alias("tag")).where(F.col("tag").startswith("#"))
        return panes.sliding(tags, "ts", "60 seconds", "10 seconds", [panes.counted("n")], ["tag"], "10 seconds")

    return windows.most_used_first(_in_steps(t, build))


@query(f"""
SELECT "start", "end", event_type, {_TOTAL} FROM {_bounds(_DAY)} WHERE {_closed(_HOUR)} GROUP BY 1, 2, 3""")
def closed_tumbling(t: Tables):
    return run_to_table(windows.windowed(_events(t), "ts", "1 day", [_total()], keys=["event_type"], late="1 hour"))


@query(f"""
SELECT "start", "end", CAST(sum(length(props)) AS BIGINT) AS chars FROM {_bounds(_HOUR)} WHERE {_closed(600)} GROUP BY 1, 2""")
def closed_sum_len(t: Tables):
    sums = windows.windowed(_events(t), "ts", "60 minutes", [F.sum(F.length("props")).alias("chars")], late="10 minutes")
    return run_to_table(sums)


@query(f"""
SELECT "start", "end", CAST(sum(length(props)) AS DOUBLE) / count(*) AS mean_length FROM {_bounds(5)} WHERE {_closed(5)} GROUP BY 1, 2""")
def closed_avg_len(t: Tables):
    return run_to_table(windows.mean_length(_events(t), "ts", "props", late="5 seconds"))


def _clicks_and_purchases(rows):
    return [
        rows.where(F.col("event_type") == kind).select(F.col("event_id").alias(f"{kind}_id"), "user_id", F.col("ts").alias(f"{kind}_ts"))
        for kind in ("click", "purchase")
    ]


_PAIRS = """pairs AS (
  SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id, c.ts
  FROM events c {how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
    ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 6 HOURS
  WHERE c.event_type = 'click')"""


@query(f"WITH {_PAIRS.format(how='')} SELECT click_id, purchase_id, user_id FROM pairs")
def stream_interval_join(t: Tables):
    """Purchases within six hours of a click, with state by user and six-hour bucket."""
    def build(rows):
        pairs = joins.interval_join(*_clicks_and_purchases(rows), "user_id", "click_ts", "purchase_ts", "6 HOURS", "1 hour")
        return pairs.select("click_id", "purchase_id", "user_id")

    return _in_steps(t, build)


@query(f"""
WITH {_PAIRS.format(how='LEFT')},
watermark AS (
  SELECT date_trunc('milliseconds', min(last)) - INTERVAL 1 HOUR AS w
  FROM (SELECT max(ts) AS last FROM events WHERE event_type IN ('click', 'purchase') GROUP BY event_type))
SELECT click_id, purchase_id, user_id FROM pairs, watermark
WHERE purchase_id IS NOT NULL OR ts < w - INTERVAL 6 HOURS""")
def stream_interval_left_join(t: Tables):
    """A click without purchase is written when the watermark says that none can follow."""
    def build(rows):
        pairs = joins.interval_join(*_clicks_and_purchases(rows), "user_id", "click_ts", "purchase_ts", "6 HOURS", "1 hour", "left")
        return pairs.select("click_id", "purchase_id", "user_id")

    return _in_steps(t, build)


@query("""
SELECT event_id, user_id, c_name FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') RIGHT JOIN events ON user_id = c_custkey""")
def stream_static_right_join(t: Tables):
    """The table is on the left; every event stays, also of users that the table does not have."""
    some = t.customer.where("c_mktsegment = 'BUILDING'")
    named = joins.table_stream_join(some, _events(t), F.expr("user_id = c_custkey"), "right")
    return run_to_table(named.select("event_id", "user_id", "c_name"))


@query("SELECT event_id, event_type, value FROM events")
def stream_replayed_batches(t: Tables):
    """Every other batch dies after its data and before its commit, and every batch is written twice; each event is there once."""
    folder, checkpoint = scratch_path(t.spark, "arrivals"), scratch_path(t.spark, "checkpoint")
    schema = "event_id bigint, event_type string, value double"
    t.events.select("event_id", "event_type", "value").repartition(8).write.json(folder)
    sink = commits.FolderSink(t.spark, scratch_path(t.spark, "committed"), "events")
    died: set[int] = set()

    def write(batch, batch_id):
        if batch_id % 2 and batch_id not in died:
            died.add(batch_id)
            sink.stage(batch, batch_id)
            raise InterruptedError(f"batch {batch_id} dies for the first time")
        sink.write(batch, batch_id)
        sink.write(batch, batch_id)

    ended = False
    while not ended:
        before = len(died)
        stream = sources.file_stream(t.spark, folder, schema, "json", files_per_batch=2)
        try:
            sinks.start_batches(stream, write, checkpoint).awaitTermination()
            ended = True
        except StreamingQueryException:
            if len(died) == before:
                raise
    return sink.read(schema)
