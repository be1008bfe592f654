"""The traceability graph as node and edge tables, and its path queries.

Nodes: ``(label, id)``. Edges: one table per relationship type with ``src``
and ``dst`` ids:

* PROCESSED     Station → Batch   (action, time, temp_celsius, weight, event_id, event_day)
* USES_RECIPE   Batch → Recipe
* REQUIRES      Recipe → Ingredient
* DELIVERS      Driver → Batch    (action, time, truck_temp_celsius, event_id, event_day)
* DESTINED_FOR  Batch → Canteen

``event_day`` is the date of ``time`` (null if it has none). In memory and stored,
the edge tables have the same columns (``schemas.PROCESSED_EDGES`` and so on).

A stored graph (``plans.graph_store``) keeps all edges of a batch in the batch's home
part; ``Edges.of_day`` then reads only the parts that hold batches of the day.

Upserts are aggregations keyed by (src, dst): an edge keeps the properties of
its latest event (by time, then event id), so loads are deterministic and
idempotent. Rows with a null key are skipped (a graph key cannot be null).
Every query is a fixed-length path, so it is a few equi-joins; each starts
from the small filtered side and semi-joins the large edge tables down to the
batches involved before any wider join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchtrace.functions.period import Period, require_id
from batchtrace.operators.rules import event_date

PROCESSED_PROPS = ("action", "time", "temp_celsius", "weight", "event_id")
DELIVERS_PROPS = ("action", "time", "truck_temp_celsius", "event_id")


@dataclass
class Edges:
    processed: DataFrame
    uses_recipe: DataFrame
    requires: DataFrame
    delivers: DataFrame
    destined_for: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"processed": self.processed, "uses_recipe": self.uses_recipe,
                "requires": self.requires, "delivers": self.delivers,
                "destined_for": self.destined_for}

    def of_day(self, day: Period) -> Edges:
        """Edges that hold all those of every batch processed on the day; here, all edges."""
        return self


def _keyed(df: DataFrame, src: str, dst: str) -> DataFrame:
    return df.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())


def latest(df: DataFrame, props: tuple[str, ...], *also: str) -> DataFrame:
    """One row per (src, dst): the properties of the latest event. ``also`` names
    columns that are the same for all rows of an edge.

    The latest event is the ``max`` of (time, event id, other properties): an aggregate,
    so it combines per map task before the shuffle, and a hot (src, dst) pair costs one
    row per task, not all its rows. The version is part of the kept struct, so every
    property is sorted and shuffled once, and rows of the same version have one winner.
    """
    version = ("time", "event_id")
    pick = F.max(F.struct(*version, *[p for p in props if p not in version]))
    kept = df.groupBy("src", "dst", *also).agg(pick.alias("_p")).select("src", "dst", *[f"_p.{p}" for p in props], *also)
    return kept.withColumn("event_day", event_date(F.col("time")))


def ingredient_rows(k: DataFrame) -> DataFrame:
    """(recipe_id, item) for every distinct (recipe, item list) of the kitchen
    rows: a recipe has few lists of items, so few lists are exploded."""
    lists = k.select("recipe_id", F.col("ingredients.item").alias("items")).distinct()
    return lists.select("recipe_id", F.explode_outer("items").alias("item"))


def build_nodes(k: DataFrame, d: DataFrame) -> DataFrame:
    """Distinct ``(label, id)`` over both tables; null ids skipped."""
    def tagged(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
        arr = F.array(*[F.struct(F.lit(lbl).alias("label"), F.col(c).alias("id")) for lbl, c in pairs])
        return df.select(F.inline(arr))

    parts = [
        tagged(k, [("Batch", "batch_id"), ("Station", "station_id"), ("Recipe", "recipe_id")]),
        ingredient_rows(k).select(F.lit("Ingredient").alias("label"), F.col("item").alias("id")),
        tagged(d, [("Batch", "batch_id"), ("Driver", "driver_id"), ("Canteen", "canteen_id")]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("id").isNotNull()).distinct()


def processed_events(k: DataFrame) -> DataFrame:
    return _keyed(k.select(F.col("station_id").alias("src"), F.col("batch_id").alias("dst"),
                           "action", F.col("event_timestamp").alias("time"),
                           F.col("temperature_celsius").alias("temp_celsius"),
                           F.col("weight_kg").alias("weight"), "event_id"), "src", "dst")


def delivers_events(d: DataFrame) -> DataFrame:
    return _keyed(d.select(F.col("driver_id").alias("src"), F.col("batch_id").alias("dst"),
                           "action", F.col("event_timestamp").alias("time"),
                           "truck_temp_celsius", "event_id"), "src", "dst")


def build_edges(k: DataFrame, d: DataFrame) -> Edges:
    ing = ingredient_rows(k)
    return Edges(
        processed=latest(processed_events(k), PROCESSED_PROPS),
        uses_recipe=_keyed(k.select(F.col("batch_id").alias("src"), F.col("recipe_id").alias("dst")),
                           "src", "dst").distinct(),
        requires=_keyed(ing.select(F.col("recipe_id").alias("src"), F.col("item").alias("dst")),
                        "src", "dst").distinct(),
        delivers=latest(delivers_events(d), DELIVERS_PROPS),
        destined_for=_keyed(d.select(F.col("batch_id").alias("src"), F.col("canteen_id").alias("dst")),
                            "src", "dst").distinct(),
    )


def upsert_edges(existing: Edges, new: Edges) -> Edges:
    """Merge a new load into stored edges: union, then the same per-key
    reduction as a fresh load, so reloading the same events changes nothing."""
    return Edges(
        processed=latest(existing.processed.unionByName(new.processed), PROCESSED_PROPS),
        uses_recipe=existing.uses_recipe.unionByName(new.uses_recipe).distinct(),
        requires=existing.requires.unionByName(new.requires).distinct(),
        delivers=latest(existing.delivers.unionByName(new.delivers), DELIVERS_PROPS),
        destined_for=existing.destined_for.unionByName(new.destined_for).distinct(),
    )


def _day(day: Period | str) -> Period:
    p = day if isinstance(day, Period) else Period.day(day)
    if p.kind != "day":
        raise ValueError(f"a day is needed, got {p.label}")
    return p


def _on_day(edges_df: DataFrame, day: Period | str) -> DataFrame:
    """Edges whose time falls on the day; prunes stored tables to one directory."""
    return edges_df.filter(_day(day).contains("event_day"))


def ingredient_recall(edges: Edges, ingredient: str, day: Period | str) -> DataFrame:
    """Batches whose recipe requires the ingredient, that some station
    processed on the day, with their destination canteens (distinct, by
    canteen)."""
    item = require_id(ingredient, "ingredient")
    edges = edges.of_day(_day(day))
    day_batches = (_on_day(edges.processed, day)
                   .select(F.col("dst").alias("batch_id")).distinct())
    recipes = (edges.requires.filter(F.col("dst") == item)
               .select(F.col("src").alias("recipe_id"), F.col("dst").alias("target_ingredient")))
    batches = (edges.uses_recipe.select(F.col("src").alias("batch_id"), F.col("dst").alias("recipe_id"))
               .join(day_batches, "batch_id", "left_semi")
               .join(recipes, "recipe_id"))
    canteens = (edges.destined_for.select(F.col("src").alias("batch_id"), F.col("dst").alias("affected_canteen"))
                .join(day_batches, "batch_id", "left_semi"))
    return (batches.join(canteens, "batch_id")
            .select("target_ingredient", F.col("recipe_id").alias("recipe_used"), "batch_id", "affected_canteen")
            .distinct()
            .orderBy("affected_canteen", "batch_id", "recipe_used"))


def contamination_risk(edges: Edges, station: str, day: Period | str) -> DataFrame:
    """For each batch the station processed on the day: the stations that
    processed it strictly later (sorted, joined by ", ", or "None"), crossed
    with the drivers delivering it and its destination canteens."""
    s = require_id(station, "station")
    edges = edges.of_day(_day(day))
    p1 = (_on_day(edges.processed.filter(F.col("src") == s), day)
          .select(F.col("src").alias("risk_station"), F.col("dst").alias("shared_batch"),
                  F.col("time").alias("_t1")))
    batches = p1.select(F.col("shared_batch").alias("dst")).distinct()
    # A later event is on the same day or a later one; an undated time is compared as text.
    not_before = F.col("event_day").isNull() | (F.col("event_day") >= F.lit(_day(day).start))
    p2 = (edges.processed.filter(not_before).select("dst", "src", "time").join(batches, "dst", "left_semi")
          .select(F.col("dst").alias("_b2"), F.col("src").alias("_later"), F.col("time").alias("_t2")))
    later = (p1.join(p2, (p1["shared_batch"] == p2["_b2"]) & (p2["_t2"] > p1["_t1"]), "left")
             .groupBy("risk_station", "shared_batch")
             .agg(F.sort_array(F.collect_set("_later")).alias("_later_list")))
    later_text = F.when(F.size("_later_list") > 0, F.concat_ws(", ", "_later_list")).otherwise(F.lit("None"))
    later = later.select("risk_station", "shared_batch", later_text.alias("later_stations"),
                         F.size("_later_list").cast("long").alias("n_later_stations"))
    drivers = (edges.delivers.select("dst", "src").join(batches, "dst", "left_semi")
               .select(F.col("dst").alias("shared_batch"), F.col("src").alias("exposed_driver")))
    canteens = (edges.destined_for.select(F.col("src").alias("shared_batch"), F.col("dst").alias("affected_canteen"))
                .join(batches.select(F.col("dst").alias("shared_batch")), "shared_batch", "left_semi"))
    return (later.join(drivers, "shared_batch").join(canteens, "shared_batch")
            .select("risk_station", "shared_batch", "later_stations", "n_later_stations",
                    "exposed_driver", "affected_canteen")
            .orderBy("shared_batch", "exposed_driver", "affected_canteen"))
