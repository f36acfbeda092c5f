"""The review message stream.

``to_messages`` turns review rows into JSON messages; ``clean_messages`` is
the tolerant consumer's filter and is the *same function* for a batch frame
and a streaming frame; ``minute_buckets`` adds the event-time minute a
message is filed under. Writers and readers take Kafka when the connector is
on the class path and JSON-lines / CSV folders otherwise (tests, backfills).

Delivery: the source commits offsets automatically (at least once). The
streaming writers here use a checkpoint folder and Spark's file sink, which
commits each micro-batch once, so a restarted query writes nothing twice.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.materialize import committed_folders
from ..sources.io import CSV_OPTIONS, PACKED, UNPACK, ZSTD_LEVEL

# Fixed value: message fields and their JSON types as produced.
MESSAGE_SCHEMA = ("id string, text string, user_id bigint, product_id string, "
                  "rating bigint, created_at string")
MINUTE_FIELDS = ("author_id", "created_at", "text")
TOPIC_FILE_SCHEMA = "offset bigint, key string, value string"
FILE_MESSAGES = 100_000


def to_messages(rows: DataFrame, created_at: str | Column = "created_at", key_col: str = "message_key",
                id_mode: str = "uuid5", text_limit: int | None = None) -> DataFrame:
    """Review rows -> ``(key, value)`` with ``value`` the JSON message.

    ``id_mode="uuid5"`` derives the message id from the row key so a replay
    produces the same ids; ``"random"`` draws a fresh UUID per message as the
    source does. The whole text is sent; ``text_limit`` cuts it to its first
    code points, as the source does with 240. An id or rating that is no
    number becomes NULL (``bad_numbers`` lists such rows), an absent one 0.
    """
    mid = (clean.uuid5_from_name(F.concat(F.lit("msg_"), F.col(key_col).cast("string")))
           if id_mode == "uuid5" else F.expr("uuid()"))
    ts = F.col(created_at) if isinstance(created_at, str) else created_at
    msg = F.struct(
        mid.alias("id"),
        (F.coalesce("review_body", F.lit("")) if text_limit is None
         else clean.truncate_text("review_body", text_limit)).alias("text"),
        clean.int_or_zero("user_id").alias("user_id"),
        F.col("product_id"),
        clean.int_or_zero("rating").alias("rating"),
        ts.alias("created_at"))
    return rows.select(F.col(key_col).cast("string").alias("key"), F.to_json(msg).alias("value"))


def bad_numbers(rows: DataFrame, cols: tuple[str, ...] = ("user_id", "rating")) -> DataFrame:
    """Rows with a value in ``cols`` that is neither absent nor an integer."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | clean.int_or_zero(c).isNull()
    return rows.where(bad)


def parse_messages(messages: DataFrame) -> DataFrame:
    """The produced message fields back from ``value``."""
    return messages.select(F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).alias("m")).select("m.*")


def _py_truthy(v: Column) -> Column:
    """Python truthiness of a JSON value held as VARIANT: NULL/missing, 0,
    false, '' and empty arrays/objects are falsy; everything else is truthy."""
    t = F.schema_of_variant(v)
    return (F.when(v.isNull() | (t == "VOID"), F.lit(False))
            .when(t == "STRING", F.try_variant_get(v, "$", "string") != "")
            .when(t == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
            .when(t.startswith("ARRAY"), F.to_json(v) != "[]")
            .when(t.startswith("OBJECT"), F.to_json(v) != "{}")
            .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(True))))


def _py_text(v: Column) -> Column:
    """How the consumer writes a JSON scalar out (booleans as Python spells them)."""
    t = F.schema_of_variant(v)
    return (F.when(t == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), "True").otherwise("False"))
            .otherwise(F.try_variant_get(v, "$", "string")))


def _repeated_keys(raw: Column) -> Column:
    """The used fields of an object that names a key twice, which a VARIANT
    can't hold; NULL for anything else that doesn't parse. Read as the one
    element of an array, so that text after the object makes it invalid."""
    rows = F.from_json(F.concat(F.lit("["), raw, F.lit("]")),
                       "array<struct<user_id: variant, created_at: variant, text: variant>>")
    return F.when(F.ltrim(raw).startswith("{") & (F.size(rows) == 1), F.get(rows, F.lit(0)))


def clean_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """T2 (C11-C13): decode, flatten the text and drop unusable messages.

    The payload is parsed once as VARIANT, so each field keeps its JSON type:
    empty or invalid JSON and falsy payloads are dropped, and so are truthy
    non-object payloads (``[1]``, ``5``), on which the source consumer fails.
    Author, time and cleaned text must be truthy by Python's rules (author
    ``0`` or ``false`` is dropped, the string ``"0"`` is kept); a time or text
    that is not a string is dropped (the source fails on it). Of a repeated
    key the last value counts.
    """
    def parsed(raw: Column) -> Column:
        return F.struct(raw.alias("raw"), F.try_parse_json(raw).alias("v"))

    def second_try(m: Column) -> Column:
        return F.struct(m["v"].alias("v"), F.when(m["v"].isNull(), _repeated_keys(m["raw"])).alias("again"))

    def fields(m: Column) -> Column:
        v, again = m["v"], m["again"]
        return F.struct(
            F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), again.isNotNull()).alias("obj"),
            *[F.when(v.isNull(), again[c]).otherwise(F.try_variant_get(v, f"$.{c}", "variant")).alias(c)
              for c in ("user_id", "created_at", "text")])

    def cleaned(m: Column) -> Column:
        author, created, text = m["user_id"], m["created_at"], m["text"]
        text_s = F.when(F.schema_of_variant(text) == "STRING", F.try_variant_get(text, "$", "string"))
        text_ok = (F.schema_of_variant(text) == "STRING") | ~_py_truthy(text)   # must be text; falsy -> ''
        return F.struct(
            _py_text(author).alias("author_id"),
            F.when(F.schema_of_variant(created) == "STRING", F.try_variant_get(created, "$", "string")).alias("created_at"),
            clean.one_line(text_s).alias("text"),
            (m["obj"] & _py_truthy(author) & F.coalesce(text_ok, F.lit(True))).alias("_ok"))

    # each step binds its results for the next, as columns would be put in
    # place wherever they are used and every use would parse the message again
    rows = F.array(F.col(value_col).cast("string"))
    for step in (parsed, second_try, fields, cleaned):
        rows = F.transform(rows, step)
    usable = F.filter(rows, lambda m: m["_ok"] & (F.coalesce(m["created_at"], F.lit("")) != "") & (m["text"] != ""))
    return messages.select(F.inline(usable)).select("author_id", "created_at", "text")


def minute_buckets(cleaned: DataFrame) -> DataFrame:
    """T3 (C22): the ``dd_MM_yyyy_HH_mm`` minute of each message, in the
    message's own offset. Rows whose time cannot be parsed get NULL (see
    ``split_rejects``)."""
    return cleaned.withColumn("minute", clean.minute_key("created_at"))


def split_rejects(bucketed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a minute, and rows whose ``created_at`` did not parse."""
    return bucketed.where(F.col("minute").isNotNull()), bucketed.where(F.col("minute").isNull())


def minute_counts(bucketed: DataFrame) -> DataFrame:
    """T4 (batch): rows per minute file."""
    return bucketed.where(F.col("minute").isNotNull()).groupBy("minute").agg(F.count(F.lit(1)).alias("n_rows"))


def minute_counts_stream(bucketed: DataFrame, watermark: str | None = None) -> DataFrame:
    """T4 (stream): rows per event-time minute. Every row counts, however late
    (one number of state per minute seen); times that don't parse have no
    minute, see ``split_rejects``. An explicit ``watermark`` drops the state of
    a minute, and rows that come later than it, once it has passed."""
    if watermark is None:
        return minute_counts(bucketed)
    wall = F.try_to_timestamp(F.substring("created_at", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    return (bucketed.withColumn("event_time", wall).where(F.col("event_time").isNotNull())
            .withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 minute")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.date_format("window.start", "dd_MM_yyyy_HH_mm").alias("minute"), "n_rows"))


# ---- sources and sinks (S11-S14) ------------------------------------------------

def read_stream(spark: SparkSession, source: str, *, topic: str | None = None,
                bootstrap: str | None = None, group: str | None = None,
                starting_offsets: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """A stream of raw message values (column ``value``).

    ``source="kafka"`` subscribes to ``topic`` from the latest offset;
    otherwise ``source`` is a folder of JSON-lines files holding one
    ``{offset, key, value}`` record per message (the layout ``write_messages``
    produces). ``max_per_trigger`` bounds each micro-batch (offsets for Kafka,
    files for folders), so a backlog after downtime is worked off in
    bounded batches instead of one huge one.
    """
    if source == "kafka":
        r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("subscribe", topic).option("startingOffsets", starting_offsets))
        if group:
            r = r.option("kafka.group.id", group)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return r.load().select(F.col("value").cast("string").alias("value"))
    r = spark.readStream.schema(TOPIC_FILE_SCHEMA).options(**UNPACK)
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_per_trigger))
    return r.json(source).select("value")


def read_topic(spark: SparkSession, source: str, *, topic: str | None = None,
               bootstrap: str | None = None) -> DataFrame:
    """S14 (batch): every message from the beginning, with its position."""
    if source == "kafka":
        return (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                .option("subscribe", topic).option("startingOffsets", "earliest")
                .option("endingOffsets", "latest").load()
                .select(F.col("offset"), F.col("key").cast("string").alias("key"),
                        F.col("value").cast("string").alias("value")))
    return spark.read.schema(TOPIC_FILE_SCHEMA).options(**UNPACK).json(source)


def topic_count(topic: DataFrame) -> DataFrame:
    """Number of messages."""
    return topic.agg(F.count(F.lit(1)).alias("n_messages"))


def topic_peek(topic: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` messages by position: every task keeps its first
    ``n``. The last step keeps later projections out of the limit, under which
    they would make it a sort of the whole topic."""
    return topic.orderBy("offset").limit(n).coalesce(1)


def write_messages(messages: DataFrame, sink: str, *, topic: str | None = None,
                   bootstrap: str | None = None, mode: str = "append",
                   packed: dict[str, str] = PACKED) -> None:
    """Send ``(key, value)`` messages. Kafka with ``acks=all`` and a 50 ms
    linger, as the source producer; otherwise a JSON-lines folder that keeps
    the position of each message, in packed files of at most ``FILE_MESSAGES``
    messages (one task reads a packed file). ``packed`` are the writer's options
    for that: gzip, or ``PACKED_WIDE`` where whole texts repeat."""
    if sink == "kafka":
        (messages.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
         .option("kafka.acks", "all").option("kafka.linger.ms", "50").save())
        return
    cols = messages.columns
    with_pos = messages if "offset" in cols else messages.withColumn(
        "offset", F.col("key").try_cast("bigint"))
    (with_pos.select("offset", "key", "value").write.mode(mode)
     .options(**packed, maxRecordsPerFile=str(FILE_MESSAGES)).json(sink))


@contextmanager
def _in_session(spark: SparkSession, options: dict[str, str]):
    """``options`` set in the session meanwhile: a stream's file sink takes a
    codec's level from there when it starts, not from its writer's options."""
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_minute_files(bucketed: DataFrame, out_dir: str, checkpoint: str, *,
                       available_now: bool = True, rejects_dir: str | None = None, by_day: bool = False,
                       packed: dict[str, str] = PACKED) -> list:
    """Append each message to its minute's CSV folder (header per file),
    one record a line: line breaks in a text are escaped (``read_minute_files``).
    ``by_day`` keeps the minutes of a day in one folder, with ``minute`` as a
    column: few files for long backlogs. The files are ``packed``: gzip, or
    ``PACKED_WIDE`` where whole texts repeat; rejects are always gzip.

    Late rows land in their own minute however late they are (no watermark,
    nothing is dropped, no state is kept). Both outputs use Spark's file sink,
    which commits every micro-batch exactly once against its checkpoint, so a
    restarted query never writes a row twice. Unparseable times go to
    ``rejects_dir`` (a second query with its own checkpoint) when given.
    Returns the started queries.
    """
    good, bad = split_rejects(bucketed)
    rows, folder = good.select(*[clean.one_record(c).alias(c) for c in MINUTE_FIELDS], "minute"), "minute"
    if by_day:
        rows, folder = rows.withColumn("day", F.substring("minute", 1, 10)), "day"

    def start(df: DataFrame, fmt: str, path: str, ckpt: str, partition: bool, packed: dict[str, str]):
        w = (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", ckpt)
             .options(**packed).outputMode("append"))
        if fmt == "csv":
            w = w.options(**CSV_OPTIONS)
        if partition:
            w = w.partitionBy(folder)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
        with _in_session(df.sparkSession, {k: v for k, v in packed.items() if k == ZSTD_LEVEL}):
            return w.start()

    queries = [start(rows, "csv", out_dir, checkpoint, True, packed)]
    if rejects_dir:
        queries.append(start(bad.select("author_id", "created_at", "text"), "json", rejects_dir,
                             checkpoint.rstrip("/") + "-rejects", False, PACKED))
    return queries


def merge_minute_counts(batch: DataFrame, batch_id: int, counts_dir: str, fold_every: int = 16) -> None:
    """T4: one micro-batch's rows per minute, merged into the counts below
    ``counts_dir``. The batch id guards it: a batch has one folder, which a
    repeated batch replaces, so none counts twice. Every ``fold_every`` batches
    the folders are added up into one, which readers then start from."""
    minute_counts(batch).write.mode("overwrite").parquet(f"{counts_dir}/batch-{batch_id}")
    if (batch_id + 1) % fold_every == 0:
        read_minute_counts(batch.sparkSession, counts_dir, batch_id).write.mode("overwrite").parquet(f"{counts_dir}/upto-{batch_id}")


def read_minute_counts(spark: SparkSession, counts_dir: str, last: int | None = None) -> DataFrame:
    """minute, n_rows over all batches merged so far (up to ``last``): the last
    folded folder and the batches after it."""
    done: dict[str, list[int]] = {"upto": [], "batch": []}
    for name in committed_folders(spark, counts_dir):
        kind, _, number = name.rpartition("-")
        if kind in done and (last is None or int(number) <= last):
            done[kind].append(int(number))
    # a folded folder of this very batch is one of a try before: read what it was made of
    base = max((b for b in done["upto"] if b != last), default=None)
    paths = [f"{counts_dir}/batch-{b}" for b in sorted(done["batch"]) if base is None or b > base]
    paths += [f"{counts_dir}/upto-{base}"] if base is not None else []
    schema = "minute string, n_rows bigint"
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.groupBy("minute").agg(F.sum("n_rows").alias("n_rows"))


def write_minute_counts(bucketed: DataFrame, counts_dir: str, checkpoint: str, fold_every: int = 16):
    """T4 as a stream without state: rows per event-time minute, however late
    they come; started from ``checkpoint``, it goes on where it stopped.
    Returns the started query, which ends when the source is read up."""
    return (bucketed.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
            .foreachBatch(lambda batch, batch_id: merge_minute_counts(batch, batch_id, counts_dir, fold_every)).start())


def _minute_records(spark: SparkSession, in_dir: str, by_day: bool = False) -> DataFrame:
    """Minute files as they are, texts still escaped."""
    schema = ", ".join(f"{c} string" for c in (*MINUTE_FIELDS, "minute", *(["day"] if by_day else [])))
    rows = spark.read.options(**CSV_OPTIONS, **UNPACK).schema(schema).csv(in_dir)
    return rows.drop("day")


def read_minute_files(spark: SparkSession, in_dir: str, by_day: bool = False) -> DataFrame:
    """author_id, created_at, text, minute of all minute files."""
    return _minute_records(spark, in_dir, by_day).select(*[clean.whole_text(c).alias(c) for c in MINUTE_FIELDS], "minute")


def compact_minutes(spark: SparkSession, in_dir: str, out_dir: str, minutes: list[str] | None = None,
                    rows_per_file: int = 5_000_000) -> None:
    """Rewrite closed minutes with few, large files (micro-batches leave many
    small ones). A minute gets ``ceil(rows / rows_per_file)`` files — one for
    any ordinary minute — and its rows are spread over them by a hash, so a
    minute holding a large share of the data is written by several tasks. Only
    the minutes rewritten are replaced in ``out_dir``; others there stay."""
    df = _minute_records(spark, in_dir)
    if minutes:
        df = df.where(F.col("minute").isin(*minutes))
    sizes = df.groupBy("minute").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(rows_per_file))).alias("_files"))
    salted = df.join(sizes, "minute").withColumn(
        "_salt", F.pmod(F.xxhash64("author_id", "created_at", "text"), F.col("_files")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))   # explicit: AQE must not merge salts back
    (salted.repartition(n, "minute", "_salt").drop("_files", "_salt")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("minute")
     .options(**CSV_OPTIONS).csv(out_dir))
