"""Averages, trends, clusters, dispersion, despiking."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scenes as sc
from ..operators import series as sr
from .frames import LONG, OBS, long_series, observations, rounded


def trend(spark, d):
    return rounded(sr.trend(long_series(spark, d)), "trend", "intercept", "unexplained_var", "trend_std", digits=3)


TREND = """SELECT transect_id, count(*) AS images_used, round(regr_slope(y, x), 3) + 0.0::DOUBLE AS trend,
  round(regr_intercept(y, x), 3) + 0.0::DOUBLE AS intercept, round(1 - regr_r2(y, x), 3) + 0.0::DOUBLE AS unexplained_var,
  round(sqrt((1 - regr_r2(y, x)) * regr_syy(y, x) / (regr_sxx(y, x) * (count(*) - 2))), 3) + 0.0::DOUBLE AS trend_std
FROM (SELECT transect_id, {y} AS y, date_diff('day', min(ts) OVER (PARTITION BY transect_id{by}), ts) / 365.2425::DOUBLE AS x{extra} FROM {frame})
GROUP BY transect_id{group} HAVING count(*) > {least}"""


def moving_average(spark, d):
    return rounded(sr.moving_average(long_series(spark, d)).select("transect_id", "scene_id", "average"), "average", digits=3)


def moving_average_two(spark, d):
    return rounded(sr.moving_average(long_series(spark, d), least=2).select("transect_id", "scene_id", "average"), "average", digits=3)


_FRAME = "(PARTITION BY transect_id ORDER BY ts RANGE BETWEEN INTERVAL '89 days 23:59:59.999999' PRECEDING AND INTERVAL '90 days' FOLLOWING)"
MOVING = f"SELECT transect_id, scene_id, round(CASE WHEN count(chainage) OVER {_FRAME} >= {{least}} THEN avg(chainage) OVER {_FRAME} END, 3) + 0.0::DOUBLE AS average FROM {LONG}"


def seasonal_average(spark, d):
    return rounded(sr.seasonal_average(long_series(spark, d)), "average", digits=3)


_SEASON = f"""SELECT transect_id, year(ts + INTERVAL 1 MONTH)::INTEGER AS year, quarter(ts + INTERVAL 1 MONTH)::INTEGER AS season, avg(chainage) AS average FROM {LONG} GROUP BY 1, 2, 3"""
SEASONAL = f"""SELECT s.transect_id, s.year, s.season, make_date(s.year, (s.season - 1) * 3 + 1, 1)::TIMESTAMP AS ts, round(average, 3) + 0.0::DOUBLE AS average
FROM ({_SEASON}) s WHERE EXISTS (SELECT 1 FROM {LONG} o WHERE o.transect_id = s.transect_id AND year(o.ts) = s.year)"""


def monthly_average(spark, d):
    return rounded(sr.monthly_average(long_series(spark, d)), "average", digits=3)


MONTHLY = f"""WITH l AS (SELECT transect_id, max(ts) AS last FROM {LONG} GROUP BY 1),
m AS (SELECT transect_id, date_trunc('month', ts)::TIMESTAMP + INTERVAL 14 DAY AS ts, avg(chainage) AS a FROM {LONG} GROUP BY 1, 2)
SELECT transect_id, ts, round(a, 3) + 0.0::DOUBLE AS average FROM m JOIN l USING (transect_id) WHERE ts <= last - INTERVAL 30 DAY"""


def seasonal_trend(spark, d):
    means = sr.seasonal_average(long_series(spark, d)).select("transect_id", "season", "ts", F.col("average").alias("chainage"))
    out = sr.trend(means, least=2, key=["transect_id", "season"])
    return rounded(out, "trend", "intercept", "unexplained_var", "trend_std", digits=3)


SEASONAL_TREND = """SELECT transect_id, season, count(*) AS images_used, round(regr_slope(y, x), 3) + 0.0::DOUBLE AS trend,
  round(regr_intercept(y, x), 3) + 0.0::DOUBLE AS intercept, round(1 - regr_r2(y, x), 3) + 0.0::DOUBLE AS unexplained_var,
  round(sqrt(greatest(1 - regr_r2(y, x), 0) * regr_syy(y, x) / (regr_sxx(y, x) * (count(*) - 2))), 3) + 0.0::DOUBLE AS trend_std
FROM (SELECT transect_id, season, a AS y, date_diff('day', min(ts) OVER (PARTITION BY transect_id, season), ts) / 365.2425::DOUBLE AS x
      FROM (SELECT s.transect_id, s.season, make_date(s.year, (s.season - 1) * 3 + 1, 1) AS ts, s.average AS a FROM (""" + _SEASON + f""") s
            WHERE EXISTS (SELECT 1 FROM {LONG} o WHERE o.transect_id = s.transect_id AND year(o.ts) = s.year)))
GROUP BY transect_id, season HAVING count(*) > 2"""


def gap_clusters(spark, d):
    return sr.gap_clusters(observations(spark, d), ["transect_id", "satname"], "chainage").select("scene_id", F.col("cluster").cast("int"))


CLUSTERS = f"""SELECT scene_id, (sum(CASE WHEN chainage - p > 20 THEN 1 ELSE 0 END) OVER (PARTITION BY transect_id, satname ORDER BY chainage))::INTEGER AS cluster
FROM (SELECT *, lag(chainage) OVER (PARTITION BY transect_id, satname ORDER BY chainage) AS p FROM {OBS})"""


def dispersion(spark, d):
    stats = sr.pair_statistics(observations(spark, d), ["transect_id", "satname"], "chainage")
    return rounded(sr.dispersion_check(stats, 60, 200), "std", "median", "max", "min", "chainage")


DISPERSION = f"""SELECT *, CASE WHEN std <= 60 AND max - min <= 200 AND n >= 3 THEN median END AS chainage FROM (
SELECT transect_id, satname, round(stddev_pop(chainage), 6) AS std, round(median(chainage), 6) AS median, max(chainage) AS max, min(chainage) AS min, count(*) AS n FROM {OBS} GROUP BY 1, 2)"""


def rejection_counts(spark, d):
    obs = observations(spark, d).select("transect_id", F.col("quality").alias("scene_id"), F.when(F.col("chainage") > 120, 1).when(F.col("chainage") > 60, 2).when(F.col("chainage") < 2, 4).alias("rejection"))
    return sr.rejection_counts(obs)


REJECTIONS = f"""SELECT transect_id, quality AS scene_id, r AS rejection, count(*) AS n FROM (SELECT *, CASE WHEN chainage > 120 THEN 1 WHEN chainage > 60 THEN 2 WHEN chainage < 2 THEN 4 END AS r FROM {OBS})
WHERE r IS NOT NULL GROUP BY GROUPING SETS ((transect_id, r), (quality, r))"""


def demeaned(spark, d):
    return rounded(sr.demean(observations(spark, d)).select("scene_id", "anomaly"), "anomaly")


DEMEANED = f"SELECT scene_id, round(chainage - median(chainage) OVER (PARTITION BY transect_id), 6) + 0.0::DOUBLE AS anomaly FROM {OBS}"


def time_steps(spark, d):
    steps = sr.time_steps(observations(spark, d), ["transect_id"]).where("step_days IS NOT NULL")
    return steps.groupBy(F.round("step_days").cast("int").alias("days")).agg(F.count("*").alias("n"))


STEPS = f"""SELECT round(step)::INTEGER AS days, count(*) AS n FROM (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY transect_id ORDER BY ts, scene_id))) / 86400000000.0::DOUBLE AS step FROM {OBS}) WHERE step IS NOT NULL GROUP BY 1"""


def _thresholded(spark, d):
    return observations(spark, d).withColumn("threshold", F.col("quality") / 100.0 - 0.75)


def threshold_gate(spark, d):
    return sr.threshold_gate(_thresholded(spark, d)).groupBy("satname").agg(F.count("*").alias("n"))


GATE = f"SELECT satname, count(*) AS n FROM {OBS} WHERE quality / 100.0::DOUBLE - 0.75::DOUBLE BETWEEN -0.5 AND 0 GROUP BY 1"


def despike(spark, d):
    return sr.despike(observations(spark, d), 40).select("transect_id", "scene_id", "chainage")


def outlier_counts(spark, d):
    out = sr.reject_outliers(_thresholded(spark, d))
    return out.groupBy("transect_id", "outcome").agg(F.count("*").alias("n"))


def scene_filters(spark, d):
    obs = observations(spark, d)
    keep = sc.clear_enough(F.col("quality"), 90) & ~sc.in_months(F.col("ts"), [2]) & sc.before_retirement(F.col("satname"), F.col("ts"), "view", 2024) & sc.before_line_failure(F.col("satname"), F.col("ts"), "click", "2024-01-20")
    keep = keep & sc.accurate(F.when(F.col("quality") % 5 == 0, "PASSED"), F.col("chainage"), 100)
    return obs.where(keep).select("scene_id", "satname")


FILTERS = f"SELECT scene_id, satname FROM {OBS} WHERE quality <= 90 AND month(ts) <> 2 AND NOT (satname = 'view' AND year(ts) >= 2024) AND NOT (satname = 'click' AND ts >= TIMESTAMP '2024-01-20') AND (quality % 5 = 0 OR chainage <= 100)"


def dedup_close(spark, d):
    s = observations(spark, d).select("scene_id", F.col("transect_id").alias("site"), F.when(F.col("satname") == "click", "L7").when(F.col("satname") == "view", "L9").otherwise("L8").alias("satname"), "ts", F.col("quality").alias("n_points"), F.col("chainage").alias("sl_length"))
    return sc.drop_close(s.where("n_points >= 0"), 14_400, ["site"]).select("scene_id", "satname")


_CLOSE = f"SELECT scene_id, transect_id AS site, CASE satname WHEN 'click' THEN 'L7' WHEN 'view' THEN 'L9' ELSE 'L8' END AS satname, ts, quality AS np, chainage AS len FROM {OBS}"
DEDUP = f"""WITH s AS ({_CLOSE}), p AS (SELECT *, lead(scene_id) OVER w AS s2, lead(satname) OVER w AS sat2, lead(ts) OVER w AS ts2, lead(np) OVER w AS np2, lead(len) OVER w AS len2 FROM s WINDOW w AS (PARTITION BY site ORDER BY ts, scene_id)),
c AS (SELECT * FROM p WHERE ts2 <= ts + INTERVAL 14400 SECOND),
g AS (SELECT scene_id FROM c WHERE np < 2 OR (np2 >= 2 AND ((satname = 'L7' AND sat2 = 'L9') OR (NOT (satname = 'L9' AND sat2 = 'L7') AND len < len2)))
  UNION SELECT s2 FROM c WHERE np2 < 2 OR (np >= 2 AND np2 >= 2 AND NOT (satname = 'L7' AND sat2 = 'L9') AND ((satname = 'L9' AND sat2 = 'L7') OR len >= len2)))
SELECT scene_id, satname FROM s WHERE scene_id NOT IN (SELECT scene_id FROM g)"""


def incremental(spark, d):
    obs = observations(spark, d)
    return sc.not_yet(obs.where("quality % 2 = 0"), obs.where("quality % 2 <> 0")).select("scene_id")


INCREMENTAL = f"""SELECT scene_id FROM {OBS} a WHERE quality % 2 = 0 AND NOT EXISTS (SELECT 1 FROM {OBS} b WHERE b.quality % 2 <> 0 AND b.satname = a.satname AND date_trunc('second', b.ts) = date_trunc('second', a.ts))"""


def merged(spark, d):
    obs = observations(spark, d)
    return sc.merge(*(obs.where(F.col("satname") == s) for s in ("click", "view", "error"))).groupBy("satname").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


MERGED = f"SELECT satname, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM {OBS} WHERE satname IN ('click', 'view', 'error') GROUP BY 1"


def upsert(spark, d):
    return sc.latest(observations(spark, d), ["transect_id", "satname"], ["ts", "scene_id"]).select("transect_id", "satname", "scene_id")


UPSERT = f"SELECT transect_id, satname, max_by(scene_id, (ts, scene_id)) AS scene_id FROM {OBS} GROUP BY 1, 2"


def repeated_times(spark, d):
    hourly = observations(spark, d).withColumn("ts", F.date_trunc("hour", "ts"))
    return sc.repeated_times(hourly)


REPEATED = f"SELECT satname, date_trunc('hour', ts)::TIMESTAMP AS second, count(*) AS n, min(scene_id) AS first_scene FROM {OBS} GROUP BY 1, 2 HAVING count(*) > 1"


def scene_quality(spark, d):
    obs = observations(spark, d)
    scene = {"land": F.col("chainage") / 500, "water": 1 - F.col("chainage") / 500, "valid": F.col("quality")}
    ref = {"land": F.lit(0.1), "water": F.lit(0.9), "valid": F.lit(50)}
    return obs.where(sc.quality_tolerance(scene, ref, F.lit(0.05))).groupBy("satname").agg(F.count("*").alias("n"))


QUALITY = f"""SELECT satname, count(*) AS n FROM (SELECT *, least(0.5::DOUBLE, 0.05::DOUBLE * greatest(50 / greatest(quality, 1)::DOUBLE, 1.0::DOUBLE)) AS tol FROM {OBS})
WHERE NOT (abs(chainage / 500 - 0.1::DOUBLE) > tol OR abs((1 - chainage / 500) - 0.9::DOUBLE) > tol) GROUP BY 1"""


def one_zone(spark, d):
    s = observations(spark, d).select("scene_id", F.col("transect_id").alias("site"), "ts", (F.col("quality") % 3).alias("epsg"))
    return sc.one_zone(s, ["site"]).select("scene_id")


ZONE = f"""WITH RECURSIVE s AS (SELECT scene_id, transect_id AS site, ts, quality % 3 AS epsg FROM {OBS}),
c AS (SELECT site, epsg, row_number() OVER (PARTITION BY site ORDER BY count(*) DESC, epsg) AS r, count(*) OVER (PARTITION BY site) AS zones FROM s GROUP BY 1, 2),
m AS (SELECT site, epsg AS main FROM c WHERE r = 1 AND zones > 1),
several AS (SELECT s.*, main FROM s JOIN m USING (site)),
nxt AS (SELECT a.site, a.ts, min(b.ts) AS after FROM several a LEFT JOIN several b ON b.site = a.site AND b.ts >= a.ts + INTERVAL 24 HOUR GROUP BY 1, 2),
seed AS (SELECT site, min(ts) AS ts FROM several GROUP BY 1 UNION ALL SELECT seed.site, nxt.after FROM seed JOIN nxt ON nxt.site = seed.site AND nxt.ts = seed.ts WHERE nxt.after IS NOT NULL),
near AS (SELECT o.scene_id, o.epsg = main AS own, row_number() OVER (PARTITION BY o.site, seed.ts, o.epsg = main ORDER BY o.ts, o.scene_id) AS r FROM seed JOIN several o ON o.site = seed.site AND o.ts > seed.ts - INTERVAL 24 HOUR AND o.ts < seed.ts + INTERVAL 24 HOUR)
SELECT scene_id FROM s WHERE scene_id NOT IN (SELECT scene_id FROM near WHERE NOT own OR r > 2)"""

QUERIES = {
    "a3_trend": trend,
    "w1_moving_average": moving_average,
    "w1_moving_average_two": moving_average_two,
    "a4_seasonal_average": seasonal_average,
    "a5_monthly_average": monthly_average,
    "a6_seasonal_trend": seasonal_trend,
    "w2_gap_clusters": gap_clusters,
    "a1_a2_dispersion": dispersion,
    "a7_rejection_counts": rejection_counts,
    "w7_demeaned": demeaned,
    "w5_time_steps": time_steps,
    "f20_threshold_gate": threshold_gate,
    "w3_despike": despike,
    "w4_a8_outlier_counts": outlier_counts,
    "f1_f8_scene_filters": scene_filters,
    "j6_dedup_close": dedup_close,
    "j10_incremental": incremental,
    "u1_merged": merged,
    "w9_upsert": upsert,
    "j15_repeated_times": repeated_times,
    "f11_scene_quality": scene_quality,
    "f7_one_zone": one_zone,
}
SQL = {
    "a3_trend": TREND.format(y="chainage", by="", extra="", frame=LONG, group="", least=10),
    "w1_moving_average": MOVING.format(least=1),
    "w1_moving_average_two": MOVING.format(least=2),
    "a4_seasonal_average": SEASONAL,
    "a5_monthly_average": MONTHLY,
    "a6_seasonal_trend": SEASONAL_TREND,
    "w2_gap_clusters": CLUSTERS,
    "a1_a2_dispersion": DISPERSION,
    "a7_rejection_counts": REJECTIONS,
    "w7_demeaned": DEMEANED,
    "w5_time_steps": STEPS,
    "f20_threshold_gate": GATE,
    "f1_f8_scene_filters": FILTERS,
    "j6_dedup_close": DEDUP,
    "j10_incremental": INCREMENTAL,
    "u1_merged": MERGED,
    "w9_upsert": UPSERT,
    "j15_repeated_times": REPEATED,
    "f11_scene_quality": QUALITY,
    "f7_one_zone": ZONE,
}
