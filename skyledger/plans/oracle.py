"""Independent DuckDB statements for the registered queries (the correctness oracle).

Each statement is plain SQL over the driver's tables; the fixture views are
inlined as CTEs (same text as the Spark views). The operator logic here is
written directly in SQL, not generated from the Spark code.
"""

from __future__ import annotations

from .fixtures import duckdb_with as fx

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


# US federal holiday rules with DuckDB weekday numbers
# (dayofweek: 0 = Sunday, 1 = Monday, 4 = Thursday, 6 = Saturday).
HOLIDAY_RULES = """rules(name, month, kind, arg, nth, first_year) AS (VALUES
  ('New Year''s Day', 1, 'date', 1, 0, 1871),
  ('Martin Luther King Jr. Day', 1, 'nth', 1, 3, 1986),
  ('Washington''s Birthday', 2, 'nth', 1, 3, 1971),
  ('Memorial Day', 5, 'last', 1, 0, 1971),
  ('Juneteenth National Independence Day', 6, 'date', 19, 0, 2021),
  ('Independence Day', 7, 'date', 4, 0, 1871),
  ('Labor Day', 9, 'nth', 1, 1, 1894),
  ('Columbus Day', 10, 'nth', 1, 2, 1971),
  ('Veterans Day', 11, 'date', 11, 0, 1978),
  ('Thanksgiving', 11, 'nth', 4, 4, 1942),
  ('Christmas Day', 12, 'date', 25, 0, 1871))"""

CALENDAR = HOLIDAY_RULES + """,
years AS (SELECT unnest(range(min(YEAR), max(YEAR) + 2)) AS y FROM flights_fx),
actual AS (
  SELECT y, name, CASE kind
      WHEN 'date' THEN make_date(y, month, arg)
      WHEN 'nth' THEN make_date(y, month, 1)
           + CAST((arg - dayofweek(make_date(y, month, 1)) + 7) % 7 + 7 * (nth - 1) AS INTEGER)
      ELSE last_day(make_date(y, month, 1))
           - CAST((dayofweek(last_day(make_date(y, month, 1))) - arg + 7) % 7 AS INTEGER)
    END AS d
  FROM years JOIN rules ON y >= first_year),
cal AS (
  SELECT d AS holiday_date, name FROM actual
  UNION ALL
  SELECT CASE dayofweek(d) WHEN 6 THEN d - 1 ELSE d + 1 END, name || ' (observed)'
  FROM actual WHERE dayofweek(d) IN (0, 6)),
cal_in AS (SELECT * FROM cal WHERE year(holiday_date) IN (SELECT y FROM years))
"""

F = fx("flights_fx")

sql("year_counts", F + "SELECT YEAR, count(*) AS count FROM flights_fx GROUP BY YEAR")

sql("label_balance", F + """SELECT count(*) FILTER (WHERE DEP_DEL15 = 1) AS positives, count(*) AS total,
  round(count(*) FILTER (WHERE DEP_DEL15 = 1) * 100.0 / count(*), 6) AS pct_positive FROM flights_fx""")

sql("holiday_calendar", F + ", " + CALENDAR + "SELECT holiday_date, name FROM cal_in")

sql("holiday_flag", F + ", " + CALENDAR + """SELECT FLIGHT_ID, FL_DATE,
  CAST(CASE WHEN FL_DATE IN (SELECT holiday_date FROM cal_in) THEN 1 ELSE 0 END AS INTEGER) AS IS_HOLIDAY
FROM flights_fx""")

sql("holiday_rush", F + ", " + CALENDAR + """SELECT FLIGHT_ID, FL_DATE,
  CAST(CASE WHEN EXISTS (SELECT 1 FROM cal_in c WHERE c.holiday_date BETWEEN f.FL_DATE - 2 AND f.FL_DATE + 2)
       THEN 1 ELSE 0 END AS INTEGER) AS HOLIDAY_RUSH
FROM flights_fx f""")

sql("time_slot", fx("slot_fx") + """SELECT event_id, DEP_TIME_BLK, CASE
  WHEN DEP_TIME_BLK IN ('0600-0659', '0700-0759', '0800-0859', '0900-0959') THEN 'morning'
  WHEN DEP_TIME_BLK IN ('1000-1059', '1100-1159') THEN 'mid-morning'
  WHEN DEP_TIME_BLK IN ('1200-1259', '1300-1359', '1400-1459') THEN 'afternoon'
  WHEN DEP_TIME_BLK IN ('1500-1559', '1600-1659', '1700-1759', '1800-1859') THEN 'evening'
  WHEN DEP_TIME_BLK IN ('1900-1959', '2000-2059', '2100-2159', '2200-2259', '2300-2359', '0001-0559') THEN 'night'
  ELSE 'unknown' END AS TIME_SLOT FROM slot_fx""")

sql("season", F + """SELECT FLIGHT_ID, MONTH, CASE
  WHEN MONTH IN (12, 1, 2) THEN 'winter' WHEN MONTH IN (3, 4, 5) THEN 'spring'
  WHEN MONTH IN (6, 7, 8) THEN 'summer' WHEN MONTH IN (9, 10, 11) THEN 'fall'
  ELSE 'unknown' END AS SEASON FROM flights_fx""")

sql("nearest_reference", fx("measure_fx") + """, d AS (
  SELECT event_id,
    abs(epoch_us(DATE) - epoch_us(two_hours_prior_depart_UTC)) AS d2,
    abs(epoch_us(DATE) - epoch_us(four_hours_prior_depart_UTC)) AS d4,
    abs(epoch_us(DATE) - epoch_us(sched_depart_date_time_UTC)) AS d0
  FROM measure_fx)
SELECT event_id,
  CAST(least(d2, d4, d0) // 1000000 AS INTEGER) AS weather_condition_measured_time_from_depart,
  CASE WHEN least(d2, d4, d0) = d2 THEN '2hr_from_depart'
       WHEN least(d2, d4, d0) = d4 THEN '4hr_from_depart'
       ELSE 'on_depart' END AS closest_depart_time_weather_measurement
FROM d""")

RECENCY = """, rec AS (
  SELECT *, CAST(date_diff('day', FL_DATE, (SELECT max(FL_DATE) FROM flights_fx)) AS INTEGER) AS RecencyDays
  FROM flights_fx)
"""

sql("recency_days", F + RECENCY + "SELECT FLIGHT_ID, FL_DATE, RecencyDays FROM rec")

RFM = RECENCY + """, delayed AS (
  SELECT OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, min(RecencyDays) AS Recency, avg(DEP_DELAY) AS Monetary
  FROM rec WHERE DEP_DEL15 = 1 GROUP BY ALL),
freq AS (
  SELECT OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, sum(DEP_DEL15) / count(DEP_DEL15) AS Frequency
  FROM rec GROUP BY ALL),
rfm AS (
  SELECT d.OP_UNIQUE_CARRIER, d.OP_CARRIER_FL_NUM, Recency, Monetary, Frequency
  FROM delayed d JOIN freq f
    ON d.OP_UNIQUE_CARRIER = f.OP_UNIQUE_CARRIER AND d.OP_CARRIER_FL_NUM = f.OP_CARRIER_FL_NUM)
"""

sql("rfm_table", F + RFM + """SELECT OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, Recency,
  round(Monetary, 6) AS Monetary, round(Frequency, 6) AS Frequency FROM rfm""")

sql("rfm_quartiles", F + RFM + """, q AS (
  SELECT quantile_disc(Recency, 0.25) r1, quantile_disc(Recency, 0.5) r2, quantile_disc(Recency, 0.75) r3,
         quantile_disc(Frequency, 0.25) f1, quantile_disc(Frequency, 0.5) f2, quantile_disc(Frequency, 0.75) f3,
         quantile_disc(Monetary, 0.25) m1, quantile_disc(Monetary, 0.5) m2, quantile_disc(Monetary, 0.75) m3
  FROM rfm)
SELECT OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM, Recency, round(Monetary, 6) AS Monetary, round(Frequency, 6) AS Frequency,
  CASE WHEN Recency >= r3 THEN 'A' WHEN Recency >= r2 THEN 'B' WHEN Recency >= r1 THEN 'C' ELSE 'D' END AS R_Quartile,
  CASE WHEN Frequency > f3 THEN 'D' WHEN Frequency > f2 THEN 'C' WHEN Frequency > f1 THEN 'B' ELSE 'A' END AS F_Quartile,
  CASE WHEN Monetary >= m3 THEN 'D' WHEN Monetary >= m2 THEN 'C' WHEN Monetary >= m1 THEN 'B' ELSE 'A' END AS M_Quartile
FROM rfm, q""")

WEATHER_CAST = """, num AS (
  SELECT * REPLACE (
    round(try_cast(HourlyPrecipitation AS DOUBLE), 6) AS HourlyPrecipitation,
    round(try_cast(HourlyDryBulbTemperature AS DOUBLE), 6) AS HourlyDryBulbTemperature,
    round(try_cast(HourlyPressureChange AS DOUBLE), 6) AS HourlyPressureChange,
    round(try_cast(HourlyRelativeHumidity AS DOUBLE), 6) AS HourlyRelativeHumidity,
    round(try_cast(HourlySeaLevelPressure AS DOUBLE), 6) AS HourlySeaLevelPressure,
    round(try_cast(HourlyStationPressure AS DOUBLE), 6) AS HourlyStationPressure,
    round(try_cast(HourlyVisibility AS DOUBLE), 6) AS HourlyVisibility,
    round(try_cast(HourlyWindGustSpeed AS DOUBLE), 6) AS HourlyWindGustSpeed,
    round(try_cast(HourlyWindSpeed AS DOUBLE), 6) AS HourlyWindSpeed,
    round(try_cast(ELEVATION AS DOUBLE), 6) AS ELEVATION)
  FROM flights_fx)
"""

sql("cast_numeric", F + WEATHER_CAST + """SELECT FLIGHT_ID, HourlyPrecipitation, HourlyDryBulbTemperature,
  HourlyPressureChange, HourlyRelativeHumidity, HourlySeaLevelPressure, HourlyStationPressure, HourlyVisibility,
  HourlyWindGustSpeed, HourlyWindSpeed, ELEVATION FROM num""")

KEPT = ("HourlyPrecipitation, HourlyDryBulbTemperature, HourlyRelativeHumidity, HourlySeaLevelPressure, "
        "HourlyStationPressure, HourlyVisibility, HourlyWindSpeed, ELEVATION")
KEYS5 = "FL_DATE, OP_UNIQUE_CARRIER, TAIL_NUM, OP_CARRIER_FL_NUM, sched_depart_date_time_UTC"


def _not_null(cols: str) -> str:
    return " AND ".join(f"{c.strip()} IS NOT NULL" for c in cols.split(","))


sql("drop_incomplete", F + WEATHER_CAST + f"""SELECT FLIGHT_ID, {KEYS5}, DEP_DEL15, {KEPT} FROM num
WHERE {_not_null("FLIGHT_ID, " + KEYS5 + ", DEP_DEL15, " + KEPT)}""")

sql("large_only", F + """SELECT FLIGHT_ID, origin_iata_code, origin_type FROM flights_fx
WHERE origin_type = 'large_airport'""")

sql("enrich_self", F + WEATHER_CAST + f""", sub AS (
  SELECT {KEYS5}, DEP_DEL15, {KEPT} FROM num WHERE {_not_null(KEYS5 + ", DEP_DEL15, " + KEPT)})
SELECT s.FL_DATE, s.OP_UNIQUE_CARRIER, s.TAIL_NUM, s.OP_CARRIER_FL_NUM, s.sched_depart_date_time_UTC, s.DEP_DEL15,
  s.HourlyPrecipitation, b.FLIGHT_ID, b.origin_iata_code, b.YEAR
FROM sub s LEFT JOIN flights_fx b
  ON s.FL_DATE = b.FL_DATE AND s.OP_UNIQUE_CARRIER = b.OP_UNIQUE_CARRIER AND s.TAIL_NUM = b.TAIL_NUM
 AND s.OP_CARRIER_FL_NUM = b.OP_CARRIER_FL_NUM AND s.sched_depart_date_time_UTC = b.sched_depart_date_time_UTC""")

sql("attach_rfm", F + RFM + """SELECT f.OP_UNIQUE_CARRIER, f.OP_CARRIER_FL_NUM, f.FLIGHT_ID, r.Recency,
  round(r.Monetary, 6) AS Monetary, round(r.Frequency, 6) AS Frequency
FROM flights_fx f JOIN rfm r ON f.OP_UNIQUE_CARRIER = r.OP_UNIQUE_CARRIER AND f.OP_CARRIER_FL_NUM = r.OP_CARRIER_FL_NUM""")

LARGE = """, large AS (SELECT * FROM flights_fx WHERE origin_type = 'large_airport'),
ap AS (SELECT origin_iata_code, count(*) AS count FROM large GROUP BY 1),
apq AS (SELECT quantile_disc(count, 0.0) a0, quantile_disc(count, 0.25) a1, quantile_disc(count, 0.5) a2,
               quantile_disc(count, 0.75) a3 FROM ap),
apg AS (SELECT origin_iata_code, count, CASE WHEN count < a0 THEN 'A' WHEN count >= a0 AND count <= a1 THEN 'B'
          WHEN count > a1 AND count <= a2 THEN 'C' WHEN count > a2 AND count <= a3 THEN 'D' ELSE 'E' END AS airport_groups
        FROM ap, apq),
ca AS (SELECT OP_UNIQUE_CARRIER, count(*) AS count FROM large GROUP BY 1),
caq AS (SELECT quantile_disc(count, 0.0) c0, quantile_disc(count, 0.25) c1, quantile_disc(count, 0.5) c2,
               quantile_disc(count, 0.75) c3 FROM ca),
cag AS (SELECT OP_UNIQUE_CARRIER, count, CASE WHEN count < c0 THEN 'A' WHEN count >= c0 AND count < c1 THEN 'B'
          WHEN count >= c1 AND count < c2 THEN 'C' WHEN count >= c2 AND count < c3 THEN 'D' ELSE 'E' END AS carrier_groups
        FROM ca, caq)
"""

sql("airport_groups", F + LARGE + "SELECT origin_iata_code, count, airport_groups FROM apg")
sql("carrier_groups", F + LARGE + "SELECT OP_UNIQUE_CARRIER, count, carrier_groups FROM cag")
sql("attach_groups", F + LARGE + """SELECT l.FLIGHT_ID, l.origin_iata_code, l.OP_UNIQUE_CARRIER, a.airport_groups, c.carrier_groups
FROM large l LEFT JOIN apg a ON l.origin_iata_code = a.origin_iata_code
LEFT JOIN cag c ON l.OP_UNIQUE_CARRIER = c.OP_UNIQUE_CARRIER""")

sql("quantile_cuts", F + """, v AS (SELECT OP_UNIQUE_CARRIER, count(*) AS count FROM flights_fx GROUP BY 1)
SELECT CAST(quantile_disc(count, 0.0) AS DOUBLE) AS q0, CAST(quantile_disc(count, 0.25) AS DOUBLE) AS q25,
       CAST(quantile_disc(count, 0.5) AS DOUBLE) AS q50, CAST(quantile_disc(count, 0.75) AS DOUBLE) AS q75,
       CAST(quantile_disc(count, 1.0) AS DOUBLE) AS q100 FROM v""")

sql("class_counts", "SELECT quality, count(*) AS count FROM labels GROUP BY quality")

# ---------------------------------------------------------------- splits, folds, metrics

sql("time_split", F + """SELECT FLIGHT_ID, YEAR, CASE WHEN YEAR = 2001 THEN 'test' ELSE 'train' END AS split
FROM flights_fx WHERE YEAR BETWEEN 1995 AND 2001""")


def md5_uniform(seed, key: str) -> str:
    return f"(CAST('0x' || substr(md5(concat('{seed}', '-', {key})), 1, 8) AS BIGINT) / 4294967296.0)"


sql("random_split_md5", F + f"""SELECT FLIGHT_ID, CASE WHEN {md5_uniform(512, 'FLIGHT_ID')} < 0.8 THEN 'train' ELSE 'test' END
  AS split FROM flights_fx""")

CLASS_COUNTS = """, cc AS (SELECT DEP_DEL15, count(*) AS n FROM flights_fx GROUP BY 1),
ext AS (SELECT max(n) AS mx, min(n) AS mn FROM cc)
"""

sql("upsample", F + CLASS_COUNTS + """, rep AS (
  SELECT DEP_DEL15, CASE WHEN n = mx THEN 1 ELSE CAST(floor(mx / mn) AS INTEGER) END AS r FROM cc, ext)
SELECT f.FLIGHT_ID, f.DEP_DEL15 FROM flights_fx f JOIN rep USING (DEP_DEL15), range(rep.r) t(i)""")

sql("downsample_md5", F + CLASS_COUNTS + f"""SELECT f.FLIGHT_ID, f.DEP_DEL15 FROM flights_fx f JOIN cc USING (DEP_DEL15), ext
WHERE cc.n = ext.mn OR {md5_uniform(541, 'f.FLIGHT_ID')} < ext.mn / cc.n""")

sql("downsample_exact", F + CLASS_COUNTS + f""", ranked AS (
  SELECT FLIGHT_ID, DEP_DEL15, row_number() OVER (PARTITION BY DEP_DEL15
         ORDER BY {md5_uniform(541, 'FLIGHT_ID')}, FLIGHT_ID) AS r FROM flights_fx WHERE DEP_DEL15 IS NOT NULL)
SELECT FLIGHT_ID, DEP_DEL15 FROM ranked, ext WHERE r <= ext.mn""")

sql("downsample_by_year", F + f""", ranked AS (
  SELECT FLIGHT_ID, YEAR, DEP_DEL15, row_number() OVER (PARTITION BY YEAR, DEP_DEL15
         ORDER BY {md5_uniform(541, 'FLIGHT_ID')}, FLIGHT_ID) AS r,
         count(*) OVER (PARTITION BY YEAR, DEP_DEL15) AS n FROM flights_fx WHERE DEP_DEL15 IS NOT NULL),
ext AS (SELECT YEAR, min(n) AS mn FROM ranked GROUP BY 1)
SELECT FLIGHT_ID, ranked.YEAR, DEP_DEL15 FROM ranked JOIN ext ON ranked.YEAR = ext.YEAR WHERE r <= ext.mn""")

sql("rebalance_by_year", F + """, cc AS (SELECT YEAR, DEP_DEL15, count(*) AS n FROM flights_fx GROUP BY 1, 2),
ext AS (SELECT YEAR, max(n) AS mx, min(n) AS mn FROM cc GROUP BY 1),
rep AS (SELECT cc.YEAR, DEP_DEL15, CASE WHEN n = mx THEN 1 ELSE CAST(floor(mx / mn) AS INTEGER) END AS r
        FROM cc JOIN ext USING (YEAR))
SELECT f.FLIGHT_ID, f.YEAR, f.DEP_DEL15 FROM flights_fx f JOIN rep USING (YEAR, DEP_DEL15), range(rep.r) t(i)""")

sql("global_row_id", F + """SELECT FLIGHT_ID, FL_DATE, row_number() OVER (ORDER BY FL_DATE, FLIGHT_ID) AS row_id
FROM flights_fx""")

sql("time_series_folds", F + """, num AS (
  SELECT FLIGHT_ID, row_number() OVER (ORDER BY FL_DATE, FLIGHT_ID) AS row_id,
         (SELECT count(*) FROM flights_fx) // 4 AS chunk FROM flights_fx),
folds AS (SELECT unnest(range(3)) AS fold)
SELECT FLIGHT_ID, row_id, CAST(fold AS INTEGER) AS fold, 'train' AS role FROM num, folds
  WHERE row_id > chunk * fold AND row_id <= chunk * (fold + 1)
UNION ALL
SELECT FLIGHT_ID, row_id, CAST(fold AS INTEGER) AS fold, 'test' AS role FROM num, folds
  WHERE row_id > chunk * (fold + 1) AND row_id <= chunk * (fold + 2)""")

sql("baseline_predict", F + f""", p AS (SELECT 1.0 - count(*) FILTER (WHERE DEP_DEL15 = 1) / count(*) AS p0 FROM flights_fx)
SELECT FLIGHT_ID, DEP_DEL15, CASE WHEN {md5_uniform(451, 'FLIGHT_ID')} < p0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS prediction
FROM flights_fx, p WHERE YEAR = 2001""")

sql("sorted_predictions", f"WITH r AS ({ORACLE['baseline_predict']})" + """
SELECT *, row_number() OVER (ORDER BY prediction, FLIGHT_ID) AS position, 'ascending' AS direction FROM r
UNION ALL SELECT *, row_number() OVER (ORDER BY prediction DESC, FLIGHT_ID), 'descending' FROM r""")

M = fx("metrics_fx")

sql("confusion", M + "SELECT label, prediction, count(*) AS count FROM metrics_fx GROUP BY ALL")

sql("classification_metrics", M + """, c AS (SELECT label, prediction, count(*) AS n FROM metrics_fx GROUP BY ALL),
lab AS (SELECT label AS k, sum(n) AS n_label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM c GROUP BY 1),
prd AS (SELECT prediction AS k, sum(n) AS n_pred FROM c GROUP BY 1),
s AS (SELECT n_label, tp, CASE WHEN coalesce(n_pred, 0) > 0 THEN tp / n_pred ELSE 0.0 END AS p, tp / n_label AS r
      FROM lab LEFT JOIN prd USING (k))
SELECT round(sum(tp) / sum(n_label), 6) AS accuracy,
       round(sum(p * n_label) / sum(n_label), 6) AS weighted_precision,
       round(sum(r * n_label) / sum(n_label), 6) AS weighted_recall,
       round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END * n_label) / sum(n_label), 6) AS weighted_f1
FROM s""")

sql("balanced_accuracy", M + """SELECT round(0.5 * (
  count(*) FILTER (WHERE label = 1 AND prediction = label) / count(*) FILTER (WHERE label = 1)
+ count(*) FILTER (WHERE label <> 1 AND prediction = label) / count(*) FILTER (WHERE label <> 1)), 6) AS balanced_accuracy
FROM metrics_fx""")

sql("auc_rank", M + """, pos AS (SELECT score FROM metrics_fx WHERE label = 1 AND score IS NOT NULL),
neg AS (SELECT score FROM metrics_fx WHERE label <> 1 AND score IS NOT NULL),
negs AS (SELECT score, count(*) AS c FROM neg GROUP BY 1),
cum AS (SELECT score, c, sum(c) OVER (ORDER BY score) - c AS below FROM negs),
per_pos AS (SELECT p.score, coalesce((SELECT max(below + c) FROM cum WHERE cum.score < p.score), 0)
                 + 0.5 * coalesce((SELECT c FROM cum WHERE cum.score = p.score), 0) AS wins FROM pos p)
SELECT round(sum(wins) / ((SELECT count(*) FROM pos) * (SELECT count(*) FROM neg)), 6) AS auc FROM per_pos""")

# ---------------------------------------------------------------- graph

G = fx("routes_fx", recursive=True)

GRAPH = """, v AS (SELECT src AS id FROM routes_fx UNION SELECT dst FROM routes_fx),
nv AS (SELECT count(*)::DOUBLE AS n FROM v),
walks(s, t, k, cnt) AS (
  SELECT id, id, 0, 1::DOUBLE FROM v
  UNION ALL
  SELECT w.s, e.dst, w.k + 1, sum(w.cnt) FROM walks w JOIN routes_fx e ON w.t = e.src
  WHERE w.k < (SELECT n FROM nv) GROUP BY w.s, e.dst, w.k + 1),
sp AS (SELECT s, t, min(k) AS d FROM walks GROUP BY s, t),
sig AS (SELECT w.s, w.t, sp.d, w.cnt AS sigma FROM walks w JOIN sp ON w.s = sp.s AND w.t = sp.t AND w.k = sp.d)
"""

sql("graph_vertices", G + ", v AS (SELECT src AS id FROM routes_fx UNION SELECT dst FROM routes_fx) SELECT id FROM v")
sql("graph_edges", G + "SELECT src, dst FROM routes_fx")

sql("degree_centrality", G + GRAPH + """, o AS (SELECT src AS id, count(*) AS c FROM routes_fx GROUP BY 1),
i AS (SELECT dst AS id, count(*) AS c FROM routes_fx GROUP BY 1)
SELECT v.id, round((coalesce(o.c, 0) + coalesce(i.c, 0)) / (n - 1), 6) AS degree_centrality
FROM v LEFT JOIN o ON v.id = o.id LEFT JOIN i ON v.id = i.id, nv""")

CLOSENESS = """, cl AS (SELECT t AS id, count(*)::DOUBLE AS r, sum(d)::DOUBLE AS tot FROM sp GROUP BY t),
clo AS (SELECT v.id, CASE WHEN tot > 0 AND n > 1 THEN (r - 1) / tot * ((r - 1) / (n - 1)) ELSE 0.0 END AS closeness_centrality
        FROM v LEFT JOIN cl ON v.id = cl.id, nv)
"""

BETWEENNESS = """, bc AS (
  SELECT a.t AS id, sum(a.sigma * b.sigma / c.sigma) AS b
  FROM sig a JOIN sig b ON a.t = b.s JOIN sig c ON c.s = a.s AND c.t = b.t
  WHERE a.s <> a.t AND b.s <> b.t AND a.s <> b.t AND a.d + b.d = c.d GROUP BY a.t),
btw AS (SELECT v.id, coalesce(bc.b, 0.0) / ((n - 1) * (n - 2)) AS betweenness_centrality
        FROM v LEFT JOIN bc ON v.id = bc.id, nv)
"""

sql("closeness_centrality", G + GRAPH + CLOSENESS + "SELECT id, round(closeness_centrality, 6) AS closeness_centrality FROM clo")
sql("betweenness_centrality", G + GRAPH + BETWEENNESS +
    "SELECT id, round(betweenness_centrality, 6) AS betweenness_centrality FROM btw")

sql("airport_rank", G + GRAPH + CLOSENESS + BETWEENNESS + """, o AS (SELECT src AS id, count(*) AS c FROM routes_fx GROUP BY 1),
i AS (SELECT dst AS id, count(*) AS c FROM routes_fx GROUP BY 1),
deg AS (SELECT v.id, (coalesce(o.c, 0) + coalesce(i.c, 0)) / (n - 1) AS degree_centrality
        FROM v LEFT JOIN o ON v.id = o.id LEFT JOIN i ON v.id = i.id, nv),
sc AS (SELECT deg.id, degree_centrality, betweenness_centrality, closeness_centrality
       FROM deg JOIN btw USING (id) JOIN clo USING (id))
SELECT f.origin_iata_code, f.FLIGHT_ID, round(degree_centrality, 6) AS degree_centrality,
  round(betweenness_centrality, 6) AS betweenness_centrality, round(closeness_centrality, 6) AS closeness_centrality,
  round(degree_centrality + betweenness_centrality + closeness_centrality, 6) AS airport_rank
FROM flights_fx f LEFT JOIN sc ON f.origin_iata_code = sc.id""")

sql("subgraph", G + """, v AS (SELECT src AS id FROM routes_fx UNION SELECT dst FROM routes_fx),
pick AS (SELECT id FROM v ORDER BY id LIMIT 10)
SELECT src, dst FROM routes_fx WHERE src IN (SELECT id FROM pick) AND dst IN (SELECT id FROM pick)""")

# ---------------------------------------------------------------- feature transformers

CAT_COLS = ["R_Quartile", "F_Quartile", "M_Quartile", "closest_depart_time_weather_measurement", "SEASON", "TIME_SLOT",
            "airport_groups", "carrier_groups", "DAY_OF_MONTH"]
NUM_COLS = ["HourlyPrecipitation", "HourlyDryBulbTemperature", "HourlyRelativeHumidity", "HourlySeaLevelPressure",
            "HourlyStationPressure", "HourlyVisibility", "HourlyWindSpeed", "IS_HOLIDAY", "HOLIDAY_RUSH", "Recency",
            "Monetary", "Frequency", "ELEVATION", "weather_condition_measured_time_from_depart", "degree_centrality",
            "betweenness_centrality", "closeness_centrality", "airport_rank"]
_CORR_COLS = ["HourlyPrecipitation", "HourlyDryBulbTemperature", "HourlyRelativeHumidity", "HourlySeaLevelPressure",
              "HourlyStationPressure", "HourlyVisibility", "HourlyWindSpeed", "IS_HOLIDAY", "HOLIDAY_RUSH", "Recency",
              "Monetary", "Frequency", "degree_centrality", "betweenness_centrality", "closeness_centrality",
              "airport_rank", "ELEVATION", "DEP_DEL15"]
_SLOT = """CASE
  WHEN DEP_TIME_BLK IN ('0600-0659', '0700-0759', '0800-0859', '0900-0959') THEN 'morning'
  WHEN DEP_TIME_BLK IN ('1000-1059', '1100-1159') THEN 'mid-morning'
  WHEN DEP_TIME_BLK IN ('1200-1259', '1300-1359', '1400-1459') THEN 'afternoon'
  WHEN DEP_TIME_BLK IN ('1500-1559', '1600-1659', '1700-1759', '1800-1859') THEN 'evening'
  WHEN DEP_TIME_BLK IN ('1900-1959', '2000-2059', '2100-2159', '2200-2259', '2300-2359', '0001-0559') THEN 'night'
  ELSE 'unknown' END"""
_SEASON = """CASE
  WHEN MONTH IN (12, 1, 2) THEN 'winter' WHEN MONTH IN (3, 4, 5) THEN 'spring'
  WHEN MONTH IN (6, 7, 8) THEN 'summer' WHEN MONTH IN (9, 10, 11) THEN 'fall' ELSE 'unknown' END"""


def feats(fit: str) -> str:
    """WITH clause ending in ``feats``: the feature table, its summaries learned from the rows where ``fit`` holds."""
    graph_part = (GRAPH + CLOSENESS + BETWEENNESS).replace("routes_fx", "routes_fit")
    return (fx("flights_fx", recursive=True) + ", " + CALENDAR + f""", fitted AS (SELECT * FROM flights_fx WHERE {fit}),
routes_fit AS (SELECT DISTINCT origin_iata_code AS src, dest_iata_code AS dst FROM fitted)
""" + graph_part + """, od AS (SELECT src AS id, count(*) AS c FROM routes_fit GROUP BY 1),
idg AS (SELECT dst AS id, count(*) AS c FROM routes_fit GROUP BY 1),
central AS (SELECT v.id, (coalesce(od.c, 0) + coalesce(idg.c, 0)) / (n - 1) AS degree_centrality,
    betweenness_centrality, closeness_centrality
  FROM v LEFT JOIN od ON v.id = od.id LEFT JOIN idg ON v.id = idg.id JOIN btw ON btw.id = v.id JOIN clo ON clo.id = v.id, nv),
newest AS (SELECT max(FL_DATE) AS latest FROM fitted),
rfm AS (
  SELECT OP_UNIQUE_CARRIER, OP_CARRIER_FL_NUM,
    min(CAST(date_diff('day', FL_DATE, latest) AS INTEGER)) FILTER (WHERE DEP_DEL15 = 1) AS Recency,
    avg(DEP_DELAY) FILTER (WHERE DEP_DEL15 = 1) AS Monetary, sum(DEP_DEL15) / count(DEP_DEL15) AS Frequency
  FROM fitted, newest GROUP BY 1, 2 HAVING count(*) FILTER (WHERE DEP_DEL15 = 1) > 0),
cuts AS (
  SELECT quantile_disc(Recency, 0.25) r1, quantile_disc(Recency, 0.5) r2, quantile_disc(Recency, 0.75) r3,
         quantile_disc(Frequency, 0.25) f1, quantile_disc(Frequency, 0.5) f2, quantile_disc(Frequency, 0.75) f3,
         quantile_disc(Monetary, 0.25) m1, quantile_disc(Monetary, 0.5) m2, quantile_disc(Monetary, 0.75) m3
  FROM rfm),
letters AS (SELECT rfm.*,
  CASE WHEN Recency >= r3 THEN 'A' WHEN Recency >= r2 THEN 'B' WHEN Recency >= r1 THEN 'C' ELSE 'D' END AS R_Quartile,
  CASE WHEN Frequency > f3 THEN 'D' WHEN Frequency > f2 THEN 'C' WHEN Frequency > f1 THEN 'B' ELSE 'A' END AS F_Quartile,
  CASE WHEN Monetary >= m3 THEN 'D' WHEN Monetary >= m2 THEN 'C' WHEN Monetary >= m1 THEN 'B' ELSE 'A' END AS M_Quartile
  FROM rfm, cuts)""" + WEATHER_CAST + f""", kept AS (
  SELECT n.*, l.Recency, l.Monetary, l.Frequency, R_Quartile, F_Quartile, M_Quartile,
    CAST(date_diff('day', FL_DATE, latest) AS INTEGER) AS RecencyDays,
    CAST(CASE WHEN FL_DATE IN (SELECT holiday_date FROM cal_in) THEN 1 ELSE 0 END AS INTEGER) AS IS_HOLIDAY,
    CAST(CASE WHEN EXISTS (SELECT 1 FROM cal_in c WHERE c.holiday_date BETWEEN n.FL_DATE - 2 AND n.FL_DATE + 2)
      THEN 1 ELSE 0 END AS INTEGER) AS HOLIDAY_RUSH,
    {_SLOT} AS TIME_SLOT, {_SEASON} AS SEASON,
    abs(epoch_us(DATE) - epoch_us(two_hours_prior_depart_UTC)) AS d2,
    abs(epoch_us(DATE) - epoch_us(four_hours_prior_depart_UTC)) AS d4,
    abs(epoch_us(DATE) - epoch_us(sched_depart_date_time_UTC)) AS d0
  FROM num n JOIN letters l ON n.OP_UNIQUE_CARRIER = l.OP_UNIQUE_CARRIER AND n.OP_CARRIER_FL_NUM = l.OP_CARRIER_FL_NUM, newest
  WHERE origin_type = 'large_airport' AND TAIL_NUM IS NOT NULL AND FL_DATE IS NOT NULL AND DEP_DEL15 IS NOT NULL
    AND """ + " AND ".join(f"{c} IS NOT NULL" for c in NUM_COLS[:7]) + f"""),
fit_rows AS (SELECT * FROM kept WHERE {fit}),
av AS (SELECT origin_iata_code AS k, count(*) AS c FROM fit_rows GROUP BY 1),
aq AS (SELECT quantile_disc(c, 0.0) q0, quantile_disc(c, 0.25) q1, quantile_disc(c, 0.5) q2, quantile_disc(c, 0.75) q3 FROM av),
ag AS (SELECT k, CASE WHEN c < q0 THEN 'A' WHEN c <= q1 THEN 'B' WHEN c <= q2 THEN 'C' WHEN c <= q3 THEN 'D' ELSE 'E' END AS airport_groups FROM av, aq),
cv AS (SELECT OP_UNIQUE_CARRIER AS k, count(*) AS c FROM fit_rows GROUP BY 1),
cq AS (SELECT quantile_disc(c, 0.0) q0, quantile_disc(c, 0.25) q1, quantile_disc(c, 0.5) q2, quantile_disc(c, 0.75) q3 FROM cv),
cg AS (SELECT k, CASE WHEN c < q0 THEN 'A' WHEN c < q1 THEN 'B' WHEN c < q2 THEN 'C' WHEN c < q3 THEN 'D' ELSE 'E' END AS carrier_groups FROM cv, cq),
feats AS (
  SELECT kept.*, airport_groups, carrier_groups,
    CAST(least(d2, d4, d0) // 1000000 AS INTEGER) AS weather_condition_measured_time_from_depart,
    CASE WHEN least(d2, d4, d0) = d2 THEN '2hr_from_depart' WHEN least(d2, d4, d0) = d4 THEN '4hr_from_depart'
      ELSE 'on_depart' END AS closest_depart_time_weather_measurement,
    coalesce(degree_centrality, 0.0) AS degree_centrality, coalesce(betweenness_centrality, 0.0) AS betweenness_centrality,
    coalesce(closeness_centrality, 0.0) AS closeness_centrality,
    coalesce(degree_centrality, 0.0) + coalesce(betweenness_centrality, 0.0) + coalesce(closeness_centrality, 0.0) AS airport_rank
  FROM kept LEFT JOIN central ON origin_iata_code = central.id LEFT JOIN ag ON ag.k = origin_iata_code
  LEFT JOIN cg ON cg.k = OP_UNIQUE_CARRIER)
""")


ALL, TRAIN = feats("TRUE"), feats("YEAR BETWEEN 1995 AND 2000")


def _index(col: str, where: str = "TRUE") -> str:
    return (f", idx_{col} AS (SELECT val, row_number() OVER (ORDER BY n DESC, val) - 1 AS i, count(*) OVER () AS k FROM "
            f"(SELECT CAST({col} AS VARCHAR) AS val, count(*) AS n FROM feats WHERE {where} AND {col} IS NOT NULL GROUP BY 1))\n")


def _indexed(where: str, kind: str, out) -> str:
    joins = " ".join(f"{kind} JOIN idx_{c} ON CAST(f.{c} AS VARCHAR) = idx_{c}.val" for c in CAT_COLS)
    return ("".join(_index(c, where) for c in CAT_COLS) + "SELECT f.FLIGHT_ID, " +
            ", ".join(out(c) for c in CAT_COLS) + f" FROM feats f {joins}")


sql("string_index", ALL + _indexed("TRUE", "", lambda c: f"CAST(idx_{c}.i AS DOUBLE) AS {c}_indexed"))

sql("one_hot", ALL + _indexed("TRUE", "", lambda c: (
    f"CAST(CASE WHEN idx_{c}.i < idx_{c}.k - 1 THEN idx_{c}.i + 1 ELSE 0 END AS INTEGER) AS {c}_hot, "
    f"CAST(idx_{c}.k - 1 AS INTEGER) AS {c}_size")))

# Values unseen in the training years: no slot is hot; every known value has one.
sql("one_hot_unseen", TRAIN + _indexed("YEAR BETWEEN 1995 AND 2000", "LEFT", lambda c: (
    f"CAST(coalesce(idx_{c}.i + 1, 0) AS INTEGER) AS {c}_hot, "
    f"CAST((SELECT max(k) FROM idx_{c}) AS INTEGER) AS {c}_size")))

sql("scaled_features", ALL + "SELECT FLIGHT_ID, " + ", ".join(
    f"CASE WHEN (SELECT stddev_samp({c}) > 1e-10 * (1 + abs(avg({c}))) FROM feats) "
    f"THEN round({c} / (SELECT stddev_samp({c}) FROM feats), 6) ELSE 0.0::DOUBLE END AS scaled_{i}" for i, c in enumerate(NUM_COLS)) + " FROM feats")

sql("prepare_features_scaled", TRAIN + "SELECT FLIGHT_ID, CASE WHEN YEAR = 2001 THEN 'test' ELSE 'train' END AS split, " + ", ".join(
    f"CASE WHEN (SELECT stddev_samp({c}) > 1e-10 * (1 + abs(avg({c}))) FROM feats WHERE YEAR <= 2000) "
    f"THEN round({c} / (SELECT stddev_samp({c}) FROM feats WHERE YEAR <= 2000), 6) ELSE 0.0::DOUBLE END AS f_{i}" for i, c in enumerate(NUM_COLS)) + " FROM feats")

sql("summaries_applied", TRAIN + "SELECT FLIGHT_ID, YEAR, RecencyDays, Recency, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ["Monetary", "Frequency", *NUM_COLS[-4:]]) +
    ", R_Quartile, F_Quartile, M_Quartile, airport_groups, carrier_groups FROM feats")

sql("correlation_matrix", ALL + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
    f"CASE WHEN stddev_pop({a}) > 1e-10 * (1 + abs(avg({a}))) AND stddev_pop({b}) > 1e-10 * (1 + abs(avg({b}))) THEN round(corr({a}, {b}), 6) END AS corr FROM feats"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]))

sql("covariance_matrix", ALL + ", complete AS (SELECT * FROM feats WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _CORR_COLS)
    + "), long AS (" + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, count(*) AS n, covar_samp({a}, {b}) AS c FROM complete"
        for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:])
    + ") SELECT feature_a, feature_b, n, CASE WHEN abs(c) < 100 THEN round(c, 6) ELSE round(c, 2) END AS covariance FROM long")

sql("rfm_quartiles_rank", ORACLE["rfm_quartiles"])

# ---------------------------------------------------------------- neighbours and SMOTE (brute force on the fixture)

KNN = """WITH m AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = 5),
pairs AS (SELECT a.id, b.id AS nbr_id, list_distance(a.v, b.v) AS distance FROM m a, m b WHERE a.id <> b.id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, nbr_id) AS rank
                       FROM pairs WHERE distance > 0) WHERE rank <= 3)
"""

sql("top_k_neighbours", KNN + "SELECT id, nbr_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM knn")

PICK = f""", b AS (SELECT id, nbr_id, CAST(unnest(range(3)) AS INTEGER) AS batch FROM knn),
pick AS (SELECT id, batch, nbr_id FROM (
  SELECT *, row_number() OVER (PARTITION BY id, batch
    ORDER BY {md5_uniform(234, "concat(id, '-', batch, '-', nbr_id)")} DESC, id, batch, nbr_id) AS rn FROM b) WHERE rn = 1)
"""

sql("pick_one_neighbour", KNN + PICK + "SELECT id, batch, nbr_id FROM pick")

sql("smote_exact", KNN + PICK + f""", allv AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v,
  CASE WHEN label = 5 THEN 1 ELSE 0 END AS label FROM embeddings),
syn AS (SELECT p.id, p.batch, 1 AS label, a.v AS va, b.v AS vb,
          {md5_uniform("234-u", "concat(p.id, '-', p.batch)")} AS u
        FROM pick p JOIN allv a ON a.id = p.id JOIN allv b ON b.id = p.nbr_id),
dims AS (SELECT unnest(range(64)) AS d)
SELECT id, batch, label, CAST(d AS INTEGER) AS dim, round(va[d + 1] + u * (vb[d + 1] - va[d + 1]), 6) AS value
FROM syn, dims
UNION ALL
SELECT id, -1 AS batch, label, CAST(d AS INTEGER) AS dim, round(v[d + 1], 6) AS value FROM allv, dims""")

GKNN = """WITH m AS (SELECT vec_id AS id, vec_id % 4 AS grp, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = 5),
pairs AS (SELECT a.grp, a.id, b.id AS nbr_id, list_distance(a.v, b.v) AS distance FROM m a JOIN m b ON a.grp = b.grp AND a.id <> b.id),
knn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp, id ORDER BY distance, nbr_id) AS rank
                       FROM pairs WHERE distance > 0) WHERE rank <= 3)
"""

sql("smote_by_group_exact", GKNN + ORACLE["smote_exact"][len(KNN):].replace(
    "SELECT id, batch, label,", "SELECT CAST(id % 4 AS INTEGER) AS grp, id, batch, label,").replace(
    "SELECT id, -1 AS batch,", "SELECT CAST(id % 4 AS INTEGER) AS grp, id, -1 AS batch,"))

sql("shuffle_rows", F + "SELECT FLIGHT_ID, DEP_DEL15 FROM flights_fx")

# ---------------------------------------------------------------- experiment records

EXPERIMENTS = f""", p AS (SELECT 1.0 - count(*) FILTER (WHERE DEP_DEL15 = 1) / count(*) AS p0 FROM flights_fx),
runs(Name, seed) AS (VALUES ('majority_class_baseline', 451), ('majority_class_baseline', 452),
  ('majority_class_baseline', 453), ('random_baseline', 451), ('random_baseline', 452), ('random_baseline', 453)),
scored AS (
  SELECT 'Y' || YEAR AS dataset_name, Name, seed, DEP_DEL15 AS label,
    CASE WHEN {md5_uniform("' || seed || '", "FLIGHT_ID")} < CASE WHEN Name = 'majority_class_baseline' THEN p0 ELSE 0.5 END
         THEN 0.0 ELSE 1.0 END AS prediction
  FROM flights_fx, runs, p),
conf AS (SELECT dataset_name, Name, seed, label, prediction, count(*) AS n FROM scored GROUP BY ALL),
lab AS (SELECT dataset_name, Name, seed, label AS k, sum(n) AS n_label,
               sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM conf GROUP BY ALL),
prd AS (SELECT dataset_name, Name, seed, prediction AS k, sum(n) AS n_pred FROM conf GROUP BY ALL),
st AS (SELECT dataset_name, Name, seed, n_label, tp,
              CASE WHEN coalesce(n_pred, 0) > 0 THEN tp / n_pred ELSE 0.0 END AS pr, tp / n_label AS rc
       FROM lab LEFT JOIN prd USING (dataset_name, Name, seed, k)),
m AS (SELECT dataset_name, Name, seed, sum(tp) / sum(n_label) AS test_accuracy,
             sum(pr * n_label) / sum(n_label) AS test_precision, sum(rc * n_label) / sum(n_label) AS test_recall,
             sum(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END * n_label) / sum(n_label) AS test_f1
      FROM st GROUP BY ALL),
b AS (SELECT dataset_name, Name, seed,
             0.5 * (count(*) FILTER (WHERE label = 1 AND prediction = label) / count(*) FILTER (WHERE label = 1)
                  + count(*) FILTER (WHERE label <> 1 AND prediction = label) / count(*) FILTER (WHERE label <> 1))
             AS test_AUC, CAST(count(*) AS DOUBLE) AS n_rows
      FROM scored GROUP BY ALL),
wide AS (SELECT Name || '-' || seed || '-' || dataset_name AS run_id, Name AS run_name, dataset_name,
                'majority class' AS family, test_AUC, test_accuracy, test_precision, test_recall, test_f1, n_rows
         FROM m JOIN b USING (dataset_name, Name, seed))
"""

_WIDE_OUT = """SELECT run_id, run_name, dataset_name, family, round(test_AUC, 6) AS test_AUC,
  round(test_accuracy, 6) AS test_accuracy, round(test_precision, 6) AS test_precision,
  round(test_recall, 6) AS test_recall, round(test_f1, 6) AS test_f1, round(n_rows, 6) AS n_rows FROM wide"""

sql("experiment_pivot", F + EXPERIMENTS + _WIDE_OUT)
sql("experiment_csv", F + EXPERIMENTS + _WIDE_OUT)

sql("experiment_summary", F + EXPERIMENTS + """SELECT run_name AS Name, round(avg(test_AUC), 6) AS test_AUC,
  round(avg(test_accuracy), 6) AS test_accuracy, round(avg(test_precision), 6) AS test_precision,
  round(avg(test_recall), 6) AS test_recall, round(avg(test_f1), 6) AS test_f1, round(avg(n_rows), 6) AS n_rows,
  round(avg(test_AUC / n_rows), 6) AS test_AUC_to_cost_ratio,
  row_number() OVER (ORDER BY avg(n_rows), run_name) AS position
FROM wide WHERE dataset_name = 'Y2001' GROUP BY run_name""")

sql("feature_roundtrip", F + RECENCY + "SELECT FLIGHT_ID, YEAR, DEP_DEL15, RecencyDays FROM rec WHERE YEAR = 2001")
