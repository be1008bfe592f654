"""Raw topic messages derived from the driver's ``events`` table.

The ``events`` table stands in for the two input topics: every event row
becomes one kitchen or dispatch message (six consecutive events make one
batch's journey), with injected sensor faults and envelope corruption. All its
columns are used: one user in ten makes a hot batch (and so a hot driver and
repeated visits), ``value`` varies the weights within a batch, ``event_type`` is
part of the source name and marks an unsubscribed topic, ``props`` is a further
payload member. Some batch ids are JSON null and some event times lie on the
edges of the month or outside it. Only integer arithmetic and text building are
used, so the projection is exact and reproducible in any SQL engine. The result
has the Kafka column layout ``key, value, topic, timestamp`` (value already
decoded to text).

The projection is narrow, and a message is many times as long and as costly as its
event: a row group of events, which no reader splits, can be hours of work. So
``load_raw_messages`` first deals the (small) events out in runs of time of about
``ROWS_PER_TASK`` each, however they are stored; a run touches few dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchtrace import config as C

# --- fixed values (the projection rules of the test fixture) ---------------
# Six steps per batch, in action order; the step index is event_id % 6.
STEP_ACTIONS = C.KITCHEN_ACTIONS + C.DISPATCH_ACTIONS
BATCH_ID_BASE = 1001
SOURCE_NAME = "data_generator"
CORRUPT_VALUE = '"CORRUPT_TEXT"'
HOT_BATCH = 228
OTHER_TOPIC = "audit_events"
EDGE_TIMES = ("2023-12-31T23:59", "2024-01-01T00:00", "2024-01-31T23:59", "2024-02-01T00:00")
#: Events that one task turns into messages.
ROWS_PER_TASK = 100_000
# ---------------------------------------------------------------------------


def _idiv(x: Column, n: int) -> Column:
    """Integer division of a non-negative integer column."""
    return F.floor(x / F.lit(n)).cast("long")


def _fixed(x: Column, scale: int, digits: int) -> Column:
    """Integer ``x`` in units of 1/scale, printed as a decimal number."""
    ax = F.abs(x)
    return F.concat(
        F.when(x < 0, F.lit("-")).otherwise(F.lit("")),
        _idiv(ax, scale).cast("string"),
        F.lit("."),
        F.lpad((ax % F.lit(scale)).cast("string"), digits, "0"),
    )


def _jstr(x: Column) -> Column:
    return F.concat(F.lit('"'), x, F.lit('"'))


def _field(name: str, value: Column, keep: Column | None = None) -> Column:
    """``"name": value`` text, or null (dropped by concat_ws) when not kept."""
    text = F.concat(F.lit(f'"{name}": '), value)
    return text if keep is None else F.when(keep, text)


def _obj(*parts: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def raw_messages(events: DataFrame) -> DataFrame:
    """Project ``events`` to raw topic messages."""
    # Stage 1: integer parameters of each event (each computed once; the
    # projections below only reference them).
    i = F.col("event_id")
    base = events.select(
        i.alias("i"), F.col("ts"), "event_type", "props",
        F.floor(F.coalesce("value", F.lit(0.0))).cast("long").alias("v"),
        F.when(F.col("user_id") % F.lit(10) == 0, F.lit(HOT_BATCH)).otherwise(_idiv(i, 6)).cast("long").alias("b"),
        (i % F.lit(6)).alias("k"),
        F.when(i % F.lit(19) == 11, _idiv(i, 19) % F.lit(7)).otherwise(F.lit(-1)).alias("bad"),
    )
    i, b, k, bad = F.col("i"), F.col("b"), F.col("k"), F.col("bad")
    w0 = F.lit(1000) + (b * F.lit(737) + F.col("v")) % F.lit(4001)
    minutes = (k * F.lit(20) + (i * F.lit(7)) % F.lit(10)).cast("int")
    edge, shifted = i % F.lit(97), i % F.lit(31) == 9
    usual = F.date_format(F.timestamp_add("DAY", F.when(shifted, 35).otherwise(0), F.timestamp_add("MINUTE", minutes, F.col("ts"))),
                          "yyyy-MM-dd'T'HH:mm")
    ets = F.when((edge >= 1) & (edge <= 4), F.element_at(F.array(*map(F.lit, EDGE_TIMES)), edge.cast("int"))).otherwise(usual)
    vals = base.select(
        "i", "b", "k", "bad", "event_type", "props",
        w0.alias("w0"),
        (b % F.lit(4)).alias("r"),
        (k < 3).alias("is_kitchen"),
        ets.alias("ets"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("gen"),
        F.col("ts"),
        (F.when(i % F.lit(17) == 3, F.lit(None).cast("long"))
         .when((b * F.lit(31) + k) % F.lit(11) == 0, w0 - F.lit(350))
         .otherwise(w0 - F.lit(30) * k)).alias("w"),
        (F.when(i % F.lit(23) == 5, F.lit(None).cast("long"))
         .when(k == 0, F.lit(150) + (i * F.lit(13)) % F.lit(70))
         .when(k == 1, F.when(b % F.lit(10) == 4, F.lit(500) + (i * F.lit(17)) % F.lit(240))
               .otherwise(F.lit(750) + (i * F.lit(17)) % F.lit(250)))
         .when(k == 2, F.lit(400) + (i * F.lit(11)) % F.lit(200))
         .otherwise(F.when(b % F.lit(10) == 7, F.lit(60) + (i * F.lit(7)) % F.lit(90))
                    .otherwise((i * F.lit(7)) % F.lit(230) - F.lit(180)))).alias("t"),
    )
    w0, r, is_kitchen = F.col("w0"), F.col("r"), F.col("is_kitchen")

    def amount(mult: int) -> Column:
        return _idiv(w0 * F.lit(mult) + F.lit(5), 10)

    def one_digit(prefix: str, n: Column) -> Column:
        return F.concat(F.lit(prefix), n.cast("string"))

    # Stage 2: text pieces.
    event_id = F.concat(F.when(is_kitchen, F.lit("KIT-")).otherwise(F.lit("DIS-")), i.cast("string"))
    texts = vals.select(
        "*",
        event_id.alias("eid"),
        F.when(i % F.lit(41) == 7, F.lit("null")).otherwise(
            F.concat(F.lit('"BATCH-'), (b + F.lit(BATCH_ID_BASE)).cast("string"), F.lit('"'))).alias("bid"),
        F.element_at(F.array(*[F.lit(a) for a in STEP_ACTIONS]), (k + 1).cast("int")).alias("act"),
        F.coalesce(_fixed(F.col("w"), 100, 2), F.lit("null")).alias("w_txt"),
        F.coalesce(_fixed(F.col("t"), 10, 1), F.lit("null")).alias("t_txt"),
    )
    eid, bid, act = F.col("eid"), F.col("bid"), F.col("act")

    def ingredient(item: Column, mult: int) -> Column:
        return F.struct(item.alias("item"), amount(mult).alias("amount"))

    item_a = F.concat(F.lit("item_"), (r * 2).cast("string"))
    item_b = F.concat(F.lit("item_"), (r * 2 + 1).cast("string"))
    item_c = F.when(r % 2 == 0, F.lit("item_9")).otherwise(F.lit("item_8"))
    # ``transform`` keeps this projection out of whole-stage code, whose one method for all
    # of the text would be too long (over 8,000 bytes) for the JVM to compile.
    ingredients = F.concat(F.lit("["), F.concat_ws(", ", F.transform(
        F.array(ingredient(item_a, 5), ingredient(item_b, 3), ingredient(item_c, 2)),
        lambda x: _obj(_field("item", _jstr(x["item"])), _field("amount_kg", _fixed(x["amount"], 100, 2))))), F.lit("]"))
    event_type = F.when(is_kitchen, F.lit(C.KITCHEN_EVENT_TYPE)).otherwise(F.lit(C.DISPATCH_EVENT_TYPE))
    metadata = _obj(
        _field("event_id", _jstr(eid), bad != 3),
        _field("event_type", _jstr(event_type), bad != 5),
        _field("source", _jstr(F.concat(F.lit(f"{SOURCE_NAME}/"), F.col("event_type")))),
        _field("generated_at", _jstr(F.col("gen"))),
    )
    station_id = (F.when(k == 0, one_digit("prep_0", F.lit(1) + b % 4))
                  .when(k == 1, one_digit("cook_0", F.lit(1) + b % 6))
                  .otherwise(one_digit("pack_0", F.lit(1) + b % 4)))
    kitchen_payload = _obj(
        _field("batch_id", bid, bad != 4),
        _field("station_id", _jstr(station_id)),
        _field("recipe_id", _jstr(F.concat(F.lit("recipe_"), r.cast("string")))),
        _field("action", _jstr(act), bad != 6),
        _field("weight_kg", F.col("w_txt")),
        _field("ingredients", ingredients),
        _field("temperature_celsius", F.col("t_txt")),
        _field("event_timestamp", _jstr(F.col("ets"))),
        _field("props", F.col("props")),
    )
    dispatch_payload = _obj(
        _field("batch_id", bid, bad != 4),
        _field("canteen_id", _jstr(one_digit("cant_0", F.lit(1) + b % 5))),
        _field("driver_id", _jstr(one_digit("drv_0", F.lit(1) + b % 7))),
        _field("action", _jstr(act), bad != 6),
        _field("truck_temp_celsius", F.col("t_txt")),
        _field("event_timestamp", _jstr(F.col("ets"))),
        _field("props", F.col("props")),
    )
    payload = F.when(is_kitchen, kitchen_payload).otherwise(dispatch_payload)
    envelope = _obj(_field("metadata", metadata, bad != 1), _field("payload", payload, bad != 2))

    # Stage 3: the message.
    return texts.select(
        F.when(bad.isin(0, 1, 3), F.lit(None).cast("string")).otherwise(eid).alias("key"),
        F.when(bad == 0, F.lit(CORRUPT_VALUE)).otherwise(envelope).alias("value"),
        F.when((F.col("event_type") == "error") & (i % F.lit(29) == 3), F.lit(OTHER_TOPIC))
        .when(is_kitchen, F.lit(C.KITCHEN_TOPIC)).otherwise(F.lit(C.DISPATCH_TOPIC)).alias("topic"),
        F.col("ts").alias("timestamp"),
    )


def spread(events: DataFrame) -> DataFrame:
    """The same rows, dealt out by time to tasks of about ``ROWS_PER_TASK`` rows."""
    tasks = -(-events.count() // ROWS_PER_TASK)  # counted from the files' footers
    return events.repartitionByRange(max(tasks, 1), "ts", "event_id")


def load_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages for the ``events`` table under ``sf_dir``."""
    return raw_messages(spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")))
