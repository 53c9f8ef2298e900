"""Queries on dated observations: scans, masks, date grids, gap filling, spectral features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.functions import spectral
from landseries.operators import timeseries as ts
from landseries.plans.registry import query
from landseries.sources.views import Tables

KEYS = ["pixel", "band"]
GRID_SQL = """bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM obs),
grid_dates AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 5 DAY)) AS DATE) AS date FROM bounds),
asked AS (SELECT pixel, band, date FROM (SELECT DISTINCT pixel, band FROM obs), grid_dates),
both_rows AS (SELECT pixel, band, date, value, false AS asked FROM obs WHERE mask = 0 UNION ALL SELECT pixel, band, date, NULL, true FROM asked),
near AS (SELECT *, last_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) OVER b AS pd, last_value(value IGNORE NULLS) OVER b AS pv,
  first_value(CASE WHEN value IS NOT NULL THEN date END IGNORE NULLS) OVER a AS nd, first_value(value IGNORE NULLS) OVER a AS nv FROM both_rows
  WINDOW b AS (PARTITION BY pixel, band ORDER BY date, asked ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY pixel, band ORDER BY date, asked ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT pixel, band, date, CASE WHEN pv IS NULL THEN nv WHEN nv IS NULL OR nd = pd THEN pv
  ELSE pv + (nv - pv) * (date - pd) / (nd - pd) END AS value FROM near WHERE asked)"""


def gap_filled(t: Tables, step: int = 5) -> DataFrame:
    bounds = t.obs.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    dates = ts.date_grid(bounds, step)  # as many rows as the period has steps
    return ts.gap_fill(t.obs, t.obs.select(*KEYS).distinct().crossJoin(F.broadcast(dates)), KEYS)


@query("flagship_seasonal_by_segment", """SELECT c_mktsegment AS segment, count(*) AS pixels, round(avg(cumulative), 4) AS mean_cumulative, round(stddev_pop(cumulative), 4) AS std_cumulative,
  round(min(minimum), 4) AS least, round(avg(variation), 4) AS mean_variation FROM (
  SELECT a.pixel, sum(i) AS cumulative, min(i) AS minimum, stddev_pop(i) / (avg(i) + 1e-6) AS variation FROM (
    SELECT x.pixel, x.date, CASE WHEN abs(x.value + y.value) < 1e-5 THEN 0 ELSE (x.value - y.value) / (x.value + y.value) END AS i
    FROM filled x JOIN filled y ON x.pixel = y.pixel AND x.date = y.date AND x.band = 'purchase' AND y.band = 'click') a GROUP BY a.pixel)
  JOIN customer ON c_custkey = pixel GROUP BY 1""", GRID_SQL)
def flagship(t: Tables) -> DataFrame:
    """Scan, mask, gap fill, index of two bands, seasonal summary, join with labels, summary by label."""
    of = {b: F.col("band") == b for b in ("purchase", "click")}
    sides = [c for b, is_b in of.items() for c in (F.max(F.when(is_b, F.col("value"))).alias(b), F.max(is_b).alias(f"has_{b}"))]
    wide = gap_filled(t).groupBy("pixel", "date").agg(*sides)  # a series without a valid date has null values and counts
    index = wide.where("has_purchase and has_click").select("pixel", "date", spectral.normalised_index(F.col("purchase"), F.col("click")).alias("value"))
    summary = ts.seasonal_summary(index, ["pixel"])
    return summary.join(t.customer, F.col("pixel") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("pixels"), F.round(F.avg("cumulative"), 4).alias("mean_cumulative"), F.round(F.stddev_pop("cumulative"), 4).alias("std_cumulative"),
        F.round(F.min("minimum"), 4).alias("least"), F.round(F.avg("variation"), 4).alias("mean_variation"),
    )


@query("sc1_scan_series", "SELECT pixel, band, count(*) AS n, string_agg(strftime(date, '%Y%m%d') || ':' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS series FROM obs GROUP BY 1, 2")
def scan_series(t: Tables) -> DataFrame:
    s = F.array_sort(F.collect_list(F.struct("date", "value")))
    part = lambda x: F.concat(F.date_format(x["date"], "yyyyMMdd"), F.lit(":"), F.round(x["value"] * 100).cast("long").cast("string"))
    return t.obs.groupBy(*KEYS).agg(F.count("*").alias("n"), F.array_join(F.transform(s, part), ",").alias("series"))


@query("sc3_series_by_orbit", "SELECT pixel % 2 AS orbit, band, count(DISTINCT date) AS n_dates, round(avg(value), 6) AS mean FROM obs GROUP BY 1, 2")
def series_by_orbit(t: Tables) -> DataFrame:
    return t.obs.groupBy((F.col("pixel") % 2).alias("orbit"), "band").agg(F.count_distinct("date").alias("n_dates"), F.round(F.avg("value"), 6).alias("mean"))


@query("sc4_static_layer", "SELECT o.pixel, o.date, round(o.value, 6) AS value, round(c_acctbal, 2) AS user_layer_1 FROM obs o JOIN customer ON c_custkey = o.pixel WHERE band = 'view'")
def static_layer(t: Tables) -> DataFrame:
    return t.obs.where("band = 'view'").join(t.customer, F.col("pixel") == F.col("c_custkey")).select("pixel", "date", F.round("value", 6).alias("value"), F.round("c_acctbal", 2).alias("user_layer_1"))


@query("sc5_available_dates", "SELECT DISTINCT date FROM obs")
def available_dates(t: Tables) -> DataFrame:
    return t.obs.select("date").distinct()


@query("sc6_date_bounds", "SELECT min(date) AS first, max(date) AS last FROM obs")
def date_bounds(t: Tables) -> DataFrame:
    return t.obs.agg(F.min("date").alias("first"), F.max("date").alias("last"))


@query("sc7_enabled_sensors", "SELECT DISTINCT band AS sensor FROM obs WHERE band <> 'login'")
def enabled_sensors(t: Tables) -> DataFrame:
    return t.obs.where("band <> 'login'").select(F.col("band").alias("sensor")).distinct()


@query("sc16_dates_per_tile", "SELECT pixel % 10 AS tile, count(DISTINCT date) AS n_dates FROM obs GROUP BY 1")
def dates_per_tile(t: Tables) -> DataFrame:
    return t.obs.groupBy((F.col("pixel") % 10).alias("tile")).agg(F.count_distinct("date").alias("n_dates"))


@query("pf1_keep_bands", "SELECT pixel, date_idx, bands[2] AS b2, bands[5] AS b5 FROM stack")
def keep_bands(t: Tables) -> DataFrame:
    kept = F.transform(F.array(F.lit(2), F.lit(5)), lambda i: F.element_at("bands", i))
    return t.stack.select("pixel", "date_idx", kept.alias("k")).select("pixel", "date_idx", F.col("k")[0].alias("b2"), F.col("k")[1].alias("b5"))


EVENT_MASKS = "SELECT event_id, {} AS mask FROM events"


@query("pf2_mask_layers", EVENT_MASKS.format("CASE WHEN (event_id % 4) // 3 + (event_id % 7) // 6 + user_id % 2 = 0 THEN 0 ELSE 1 END"))
def mask_layers(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select("event_id", ts.mask_from_layers(F.floor(e % 4 / 3), F.floor(e % 7 / 6), F.col("user_id") % 2).alias("mask"))


@query("pf3_mask_scene_classes", EVENT_MASKS.format("CASE WHEN event_id % 12 IN (0, 1, 3, 8, 9, 10) THEN 1 ELSE 0 END"))
def mask_scene(t: Tables) -> DataFrame:
    return t.events.select("event_id", ts.mask_from_values(F.col("event_id") % 12, (0, 1, 3, 8, 9, 10)).alias("mask"))


@query("pf4_mask_flags", EVENT_MASKS.format("CASE WHEN event_id % 5 IN (0, 1) THEN 1 ELSE 0 END"))
def mask_flags(t: Tables) -> DataFrame:
    return t.events.select("event_id", ts.mask_from_values(F.col("event_id") % 5, (0, 1)).alias("mask"))


@query("pf5_mask_odd", EVENT_MASKS.format("CASE WHEN user_id % 2 = 1 OR event_id % 9 = 8 OR event_id % 11 = 10 THEN 1 ELSE 0 END"))
def mask_odd(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select("event_id", ts.mask_from_flags(F.col("user_id"), F.floor(e % 9 / 8), F.floor(e % 11 / 10)).alias("mask"))


@query("pf7_footprint", "SELECT pixel, band, max(1 - mask) AS footprint FROM obs GROUP BY 1, 2")
def footprint(t: Tables) -> DataFrame:
    return ts.footprint(t.obs, KEYS)


@query("pf8_common_footprint", "SELECT pixel, CASE WHEN sum(f) = 5 THEN 1 ELSE 0 END AS common FROM (SELECT pixel, band, max(1 - mask) AS f FROM obs GROUP BY 1, 2) GROUP BY 1")
def common_footprint(t: Tables) -> DataFrame:
    return ts.common_footprint(ts.footprint(t.obs, KEYS), ["pixel"], 5)


@query("pf9_mask_series", "SELECT pixel, band, string_agg(CAST(mask AS VARCHAR), '' ORDER BY date) AS masks FROM obs GROUP BY 1, 2")
def mask_series(t: Tables) -> DataFrame:
    s = F.array_sort(F.collect_list(F.struct("date", "mask")))
    return t.obs.groupBy(*KEYS).agg(F.array_join(F.transform(s, lambda x: x["mask"].cast("string")), "").alias("masks"))


@query("pf10_valid_views", "SELECT pixel, CAST(count(*) - sum(mask) AS BIGINT) AS n_views FROM obs GROUP BY 1")
def valid_views(t: Tables) -> DataFrame:
    return ts.valid_views(t.obs, ["pixel"])


@query("pf11_enough_views", "SELECT pixel, CAST(count(*) - sum(mask) AS BIGINT) AS n_views FROM obs GROUP BY 1 HAVING count(*) - sum(mask) >= 40")
def enough_views(t: Tables) -> DataFrame:
    return ts.valid_views(t.obs, ["pixel"]).where("n_views >= 40")


@query("pf12_band_math", "SELECT pixel, date_idx, round(CASE WHEN bands[1] > bands[2] THEN bands[3] + bands[4] ELSE greatest(bands[5], bands[6]) END, 6) AS value FROM stack")
def band_math(t: Tables) -> DataFrame:
    b = [F.element_at("bands", k) for k in range(1, 9)]
    return t.stack.select("pixel", "date_idx", F.round(F.when(b[0] > b[1], b[2] + b[3]).otherwise(F.greatest(b[4], b[5])), 6).alias("value"))


@query("pf13_user_index", "SELECT pixel, date_idx, round((bands[1] + bands[2]) / (bands[3] + bands[8] + bands[1] + 100000), 9) AS value FROM stack")
def user_index(t: Tables) -> DataFrame:
    """A user's expression in b1..b8, evaluated at every date."""
    named = t.stack.select("pixel", "date_idx", *(F.element_at("bands", k).alias(f"b{k}") for k in range(1, 9)))
    return named.select("pixel", "date_idx", F.round(F.expr("(b1 + b2) / (b3 + b8 + b1 + 100000)"), 9).alias("value"))


@query("pf15_clamp", "SELECT event_id, greatest(value, 5.0) AS value FROM events")
def clamp(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.greatest("value", F.lit(5.0)).alias("value"))


@query("pf17_decibels", "SELECT event_id, CAST(floor((least(greatest(10 * log10(value / 1000 + 1e-4), -25), 3) + 25) / 28.0 * 65535) AS INTEGER) AS scaled FROM events WHERE value >= 0")
def decibels(t: Tables) -> DataFrame:
    return t.events.where("value >= 0").select("event_id", spectral.decibels(F.col("value") / 1000 + 1e-4).alias("scaled"))


@query("pf20_by_platform", "SELECT user_id % 2 AS orbit, event_type AS platform, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2, 3")
def by_platform(t: Tables) -> DataFrame:
    return t.events.groupBy((F.col("user_id") % 2).alias("orbit"), F.col("event_type").alias("platform"), F.to_date("ts").alias("date")).agg(F.count("*").alias("n"))


@query("pf29_new_dates", "SELECT DISTINCT date FROM obs WHERE date NOT IN (SELECT date FROM obs WHERE pixel % 3 = 0 AND extract(day FROM date) % 2 = 0)")
def new_dates(t: Tables) -> DataFrame:
    done = t.obs.where("pixel % 3 = 0 and day(date) % 2 = 0").select("date")
    return t.obs.select("date").distinct().join(done, "date", "left_anti")


@query("ts1_date_grid", "SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 5 DAY)) AS DATE) AS date FROM obs")
def date_grid(t: Tables) -> DataFrame:
    return ts.date_grid(t.obs.agg(F.min("date").alias("first"), F.max("date").alias("last")), 5)


@query("ts2_closed_grid", "SELECT DISTINCT date FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 4 DAY)) AS DATE) AS date, hi FROM b) WHERE date < hi - INTERVAL 1 DAY UNION SELECT hi FROM b", "b AS (SELECT min(date) AS lo, max(date) AS hi FROM obs)")
def closed_grid(t: Tables) -> DataFrame:
    return ts.date_grid_closed(t.obs.agg(F.min("date").alias("first"), F.max("date").alias("last")), 4)


@query("ts3_common_bounds", "SELECT max(lo) AS first, min(hi) AS last FROM (SELECT pixel, min(date) AS lo, max(date) AS hi FROM obs GROUP BY pixel)")
def common_bounds(t: Tables) -> DataFrame:
    return ts.common_bounds(t.obs, "pixel")


@query("ts4_bounds_by_sensor", "SELECT band, greatest(min(date), DATE '2024-01-03') AS first, max(date) AS last FROM obs GROUP BY band")
def bounds_by_sensor(t: Tables) -> DataFrame:
    return t.obs.groupBy("band").agg(F.greatest(F.min("date"), F.lit("2024-01-03").cast("date")).alias("first"), F.max("date").alias("last"))


@query("ts5_gap_fill", "SELECT pixel, band, date, round(value, 6) AS value FROM filled", GRID_SQL)
def gap_fill(t: Tables) -> DataFrame:
    return gap_filled(t).withColumn("value", F.round("value", 6))


@query("ts6_gap_fill_by_orbit", "SELECT pixel % 2 AS orbit, band, date, round(avg(value), 6) AS value FROM filled GROUP BY 1, 2, 3", GRID_SQL)
def gap_fill_by_orbit(t: Tables) -> DataFrame:
    return gap_filled(t).groupBy((F.col("pixel") % 2).alias("orbit"), "band", "date").agg(F.round(F.avg("value"), 6).alias("value"))


@query("ts8_sorted_days", "SELECT pixel, CAST(coalesce(d[1], 0) AS INTEGER) AS d1, CAST(coalesce(d[2], 0) AS INTEGER) AS d2, CAST(coalesce(d[3], 0) AS INTEGER) AS d3 FROM (SELECT pixel, list(date - DATE '2024-01-01' + 1 ORDER BY value DESC, date) AS d FROM obs WHERE mask = 0 AND band = 'view' GROUP BY pixel)")
def sorted_days(t: Tables) -> DataFrame:
    days = ts.sorted_days(t.obs.where("band = 'view'"), ["pixel"], 3)
    return days.select("pixel", *(F.col("days")[k].alias(f"d{k + 1}") for k in range(3)))


@query("ts9_seasonal_summary", "SELECT pixel, band, round(sum(value), 7) AS cumulative, round(min(value), 7) AS minimum, round(stddev_pop(value) / (avg(value) + 1e-6), 6) AS variation FROM filled GROUP BY 1, 2", GRID_SQL)
def seasonal(t: Tables) -> DataFrame:
    s = ts.seasonal_summary(gap_filled(t), KEYS)
    return s.select(*KEYS, F.round("cumulative", 7).alias("cumulative"), F.round("minimum", 7).alias("minimum"), F.round("variation", 6).alias("variation"))


@query("ts10_best_reference_date", """SELECT tile, date FROM (SELECT tile, date, row_number() OVER (PARTITION BY tile ORDER BY score DESC, date) AS k FROM (
  SELECT tile, date, (1 - least((DATE '2024-01-30' - date) / 500.0, 1)) * (1 - m) * n AS score FROM (
    SELECT pixel % 10 AS tile, date, avg(mask) AS m, count(*) AS n FROM obs GROUP BY 1, 2))) WHERE k = 1""")
def best_date(t: Tables) -> DataFrame:
    scenes = t.obs.groupBy((F.col("pixel") % 10).alias("tile"), "date").agg(F.avg("mask").alias("m"), F.count("*").alias("n"))
    age = F.datediff(F.lit("2024-01-30").cast("date"), "date")
    score = (1 - F.least(age / 500.0, F.lit(1.0))) * (1 - F.col("m")) * F.col("n")
    # ties go to the earlier date
    return scenes.groupBy("tile").agg(F.max_by("date", F.struct(score, -F.unix_date("date"))).alias("date"))


@query("fx1_normalised_index", "SELECT pixel, date_idx, round(CASE WHEN abs(bands[4] + bands[3]) < 1e-5 THEN 0 ELSE (bands[4] - bands[3] - 0.05) / (bands[4] + bands[3] + 0.05) END, 6) AS value FROM stack")
def index(t: Tables) -> DataFrame:
    return t.stack.select("pixel", "date_idx", F.round(spectral.normalised_index(F.element_at("bands", 4), F.element_at("bands", 3), spectral.ATMOSPHERE), 6).alias("value"))


@query("fx2_date_features", """SELECT pixel, date_idx, round(CASE WHEN abs(bands[4] + bands[3]) < 1e-5 THEN 0 ELSE (bands[4] - bands[3]) / (bands[4] + bands[3]) END * 1000, 4) AS ndvi,
  round(CASE WHEN abs(bands[6] + bands[4]) < 1e-5 THEN 0 ELSE (bands[6] - bands[4]) / (bands[6] + bands[4]) END * 1000, 4) AS ndwi,
  round(sqrt(list_sum([v * v for v in bands])), 4) AS brightness FROM stack""")
def features(t: Tables) -> DataFrame:
    f = t.stack.select("pixel", "date_idx", spectral.date_features(F.col("bands"), 3, 4, 6).alias("f"))
    return f.select("pixel", "date_idx", *(F.round(f"f.{n}", 4).alias(n) for n in ("ndvi", "ndwi", "brightness")))


@query("fx3_relative_reflectance", "SELECT pixel, date_idx, " + ", ".join("bands[3] AS r3" if k == 3 else f"round(CASE WHEN abs(bands[{k}] + bands[3]) < 1e-5 THEN 0 ELSE (bands[{k}] - bands[3]) / (bands[{k}] + bands[3]) END, 6) AS r{k}" for k in range(1, 9)) + " FROM stack")
def relative(t: Tables) -> DataFrame:
    r = t.stack.select("pixel", "date_idx", spectral.relative_reflectance(F.col("bands"), 3).alias("r"))
    return r.select("pixel", "date_idx", *((F.col("r")[k - 1] if k == 3 else F.round(F.col("r")[k - 1], 6)).alias(f"r{k}") for k in range(1, 9)))


@query("fx9_further_indices", "SELECT pixel, date_idx, round((bands[2] - bands[6]) / (bands[2] + bands[6] + 100000), 9) AS ndsi, round(bands[5] / (bands[4] + 100000), 9) AS red_edge FROM stack")
def further(t: Tables) -> DataFrame:
    b = lambda k: F.element_at("bands", k)
    return t.stack.select("pixel", "date_idx", F.round((b(2) - b(6)) / (b(2) + b(6) + 100000), 9).alias("ndsi"), F.round(b(5) / (b(4) + 100000), 9).alias("red_edge"))


@query("fx11_feature_statistics", "SELECT i - 1 AS feature, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY 1")
def statistics(t: Tables) -> DataFrame:
    v = t.embeddings.select(F.posexplode("embedding").alias("i", "v")).withColumn("v", F.col("v").cast("double"))
    return v.groupBy(F.col("i").cast("long").alias("feature")).agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("std"))
