"""Windows, joins and the whole feature job over ``panel`` and ``visits``."""
from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.catalog import query
from panelwise.catalog.fixtures import PANEL, SCORED, VISITS, VITALS, panel, rounded, scored, table, visits, vitals
from panelwise.catalog.rules import _FLAGS, _RISK
from panelwise.operators import panel as P
from panelwise.operators.evaluation import window_hits, window_hits_by_join
from panelwise.operators.skew import col, keep_members
from panelwise.operators.splits import split_of
from panelwise.plans.featurize import featurize


def _entity_sql(columns, entity="entity_id"):
    return ", ".join(
        f"round(avg({c}) OVER e, 6) AS {c}_patient_mean, round(stddev_samp({c}) OVER e, 6) AS {c}_patient_std, "
        f"min({c}) OVER e AS {c}_patient_min, max({c}) OVER e AS {c}_patient_max"
        for c in columns
    )


@query("e1_entity_stats", f"WITH {PANEL} SELECT entity_id, period, {_entity_sql(['amt', 'amt_n'])} FROM panel WINDOW e AS (PARTITION BY entity_id)")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt", "amt_n")
    return rounded(P.entity_stats(p, "entity_id", ["amt", "amt_n"]).drop("amt", "amt_n"))


@query("f1_entity_stats_by_join", f"WITH {PANEL} SELECT entity_id, period, {_entity_sql(['amt', 'amt_n'])} FROM panel WINDOW e AS (PARTITION BY entity_id)")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt", "amt_n")
    return rounded(P.join_entity_table(p, "entity_id", ["amt", "amt_n"]).drop("amt", "amt_n"))


@query("d8_entity_table", f"""
WITH {PANEL} SELECT entity_id, round(avg(amt), 6) AS amt_mean, round(stddev_samp(amt), 6) AS amt_std, min(amt) AS amt_min, max(amt) AS amt_max,
  round(avg(n_orders), 6) AS n_orders_mean, round(stddev_samp(n_orders), 6) AS n_orders_std, min(n_orders) AS n_orders_min, max(n_orders) AS n_orders_max FROM panel GROUP BY entity_id""")
def _(spark, sf):
    return rounded(P.entity_table(panel(spark, sf), "entity_id", ["amt", "n_orders"]))


@query("e2_rolling_rows", f"""
WITH o AS (SELECT o_orderkey AS id, o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period, o_totalprice AS amt FROM orders)
SELECT id, entity_id, period, round(avg(amt) OVER w, 6) AS amt_rolling_mean, max(amt) OVER w AS amt_rolling_max FROM o
WINDOW w AS (PARTITION BY entity_id ORDER BY period, id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def _(spark, sf):
    return rounded(P.rolling_rows(_orders(spark, sf), "entity_id", "period", "id", ["amt"]).drop("amt"))


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("entity_id"), F.year("o_orderdate").cast("int").alias("period"), F.col("o_totalprice").alias("amt")
    )


def rolling_sql(c, windows=(1, 2, 3)):
    parts = []
    for w in windows:
        over = f"OVER (PARTITION BY entity_id ORDER BY period RANGE BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
        parts.append(
            f"round(coalesce(avg({c}) {over}, 0), 6) AS {c}_rolling_mean_{w}y, round(coalesce(stddev_samp({c}) {over}, 0), 6) AS {c}_rolling_std_{w}y, "
            f"coalesce(min({c}) {over}, 0) AS {c}_rolling_min_{w}y, coalesce(max({c}) {over}, 0) AS {c}_rolling_max_{w}y, count({c}) {over} AS {c}_rolling_count_{w}y"
        )
    return ", ".join(parts)


@query("e3_rolling_years", f"WITH {PANEL} SELECT entity_id, period, {rolling_sql('amt_n')} FROM panel")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt_n")
    return rounded(P.zero_fill_features(P.rolling_years(p, "entity_id", "period", ["amt_n"]), P.feature_names([], rolling_columns=["amt_n"])).drop("amt_n"))


_HOLES = "holes AS (SELECT entity_id, CASE WHEN n_orders % 2 = 1 AND period % 3 = 0 THEN NULL ELSE period END AS period, period AS grain, amt_n FROM panel)"


@query("e3_rolling_null_period", f"WITH {PANEL}, {_HOLES}, r AS (SELECT entity_id, grain, {rolling_sql('amt_n')} FROM holes) SELECT * FROM r")
def _(spark, sf):
    """Rows without a period count among each other only."""
    hole = (F.col("n_orders") % 2 == 1) & (F.col("period") % 3 == 0)
    p = panel(spark, sf).select("entity_id", F.when(~hole, F.col("period")).alias("period"), F.col("period").alias("grain"), "amt_n")
    return rounded(P.zero_fill_features(P.rolling_years(p, "entity_id", "period", ["amt_n"]), P.feature_names([], rolling_columns=["amt_n"])).drop("amt_n", "period"))


def delta_sql(c, lags=(1, 2)):
    return ", ".join(
        f"round(CAST(coalesce({c} - min({c}) OVER (PARTITION BY entity_id ORDER BY period RANGE BETWEEN {k} PRECEDING AND {k} PRECEDING), 0) AS DOUBLE), 6) AS {c}_delta_{k}y" for k in lags
    )


@query("e4_year_deltas", f"WITH {PANEL} SELECT entity_id, period, {delta_sql('amt')}, {delta_sql('amt_n')} FROM panel")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt", "amt_n")
    return rounded(P.year_deltas(p, "entity_id", "period", ["amt", "amt_n"]).drop("amt", "amt_n"))


def _hits_sql(years):
    return f"""
WITH {SCORED}, near AS (SELECT score, max(label) OVER (PARTITION BY entity_id ORDER BY period RANGE BETWEEN {years} PRECEDING AND {years} FOLLOWING) AS hit FROM scored)
SELECT count(*) AS window_positive_predictions, count(*) FILTER (hit = 1) AS window_hits, round(coalesce(count(*) FILTER (hit = 1) / nullif(count(*), 0), 0), 6) AS window_accuracy
FROM near WHERE score >= 0.5"""


@query("e5_window_hit_rate", _hits_sql(1))
def _(spark, sf):
    return rounded(window_hits(scored(spark, sf), "entity_id", "period", "label", "score", 0.5, 1))


@query("f3_window_hit_rate_by_join", _hits_sql(2))
def _(spark, sf):
    return rounded(window_hits_by_join(scored(spark, sf), "entity_id", "period", "label", "score", 0.5, 2))


@query("e7_running_sum", """
WITH o AS (SELECT o_orderkey AS id, o_custkey AS entity_id, CAST(year(o_orderdate) AS INTEGER) AS period, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT id, entity_id, period, CAST(sum(cents) OVER (PARTITION BY entity_id ORDER BY period, id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS walk FROM o""")
def _(spark, sf):
    o = _orders(spark, sf).withColumn("cents", F.round(F.col("amt") * 100).cast("bigint"))
    return P.running_sum(o, "entity_id", "period", "id", "cents", "walk").drop("amt", "cents")


@query("e8_advanced_value", f"""
WITH {VISITS}, first AS (SELECT patient_id, min(year) AS y0, arg_min(bmi, year) AS b0 FROM visits GROUP BY patient_id)
SELECT v.patient_id, v.year, b0 + (v.year - y0) AS bmi_advanced FROM visits v JOIN first f ON v.patient_id = f.patient_id""")
def _(spark, sf):
    v = visits(spark, sf).select("patient_id", "year", "bmi")
    return P.advance(v, "patient_id", "year", "bmi", "bmi_advanced").drop("bmi")


@query("f2_rows_of_split", f"""
WITH {PANEL} SELECT entity_id, period, amt FROM panel WHERE entity_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def _(spark, sf):
    members = table(spark, sf, "customer").filter(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("entity_id"))
    return keep_members(panel(spark, sf).select("entity_id", "period", "amt"), members, "entity_id")


@query("b5_membership_by_hash", f"""
WITH {PANEL} SELECT entity_id, period FROM panel WHERE CAST('0x' || substr(md5(entity_id || '|42'), 1, 8) AS BIGINT) % 10000 < 2000""")
def _(spark, sf):
    return panel(spark, sf).filter(split_of("entity_id") == "test").select("entity_id", "period")


@query("f5_densified_panel", f"""
WITH {PANEL}, e AS (SELECT DISTINCT entity_id FROM panel), y AS (SELECT CAST(unnest(range(1992, 2002)) AS INTEGER) AS period)
SELECT e.entity_id, y.period, p.amt, p.seg FROM e CROSS JOIN y LEFT JOIN panel p ON p.entity_id = e.entity_id AND p.period = y.period""")
def _(spark, sf):
    return P.densify(panel(spark, sf).select("entity_id", "period", "amt", "seg"), "entity_id", "period", 1992, 2001)


@query("h1_vertical_concat", f"WITH {PANEL} SELECT entity_id, period, amt FROM panel WHERE period < 1996 UNION ALL SELECT entity_id, period, amt FROM panel WHERE period >= 1995")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt")
    return p.filter("period < 1996").unionByName(p.filter("period >= 1995"))


@query("h3_unseen_entities", f"""
WITH {PANEL} SELECT DISTINCT entity_id FROM panel WHERE period >= 1999 AND entity_id NOT IN (SELECT entity_id FROM panel WHERE period < 1999)""")
def _(spark, sf):
    p = panel(spark, sf)
    return P.unseen_entities(p.filter("period >= 1999"), p.filter("period < 1999"), "entity_id")


@query("i18_new_rows_with_history", f"""
WITH {PANEL}, f AS (SELECT entity_id, period, round(avg(amt) OVER e, 6) AS amt_patient_mean, round(coalesce(stddev_samp(amt) OVER e, 0), 6) AS amt_patient_std,
  min(amt) OVER e AS amt_patient_min, max(amt) OVER e AS amt_patient_max, {rolling_sql('amt', (1, 2))}, {delta_sql('amt', (1,))} FROM panel WINDOW e AS (PARTITION BY entity_id))
SELECT * FROM f WHERE period = (SELECT max(period) FROM panel)""")
def _(spark, sf):
    p = panel(spark, sf).select("entity_id", "period", "amt")
    last = p.agg(F.max("period")).first()[0]
    out = P.new_rows_with_history(p.filter(F.col("period") < last), p.filter(F.col("period") == last), "entity_id", "period", ["amt"], years=(1, 2), lags=(1,))
    return rounded(out.drop("amt"))


_COLUMNS = P.NUMERIC_COLUMNS
_FEATURE_SQL = ", ".join(
    f"round(avg({c}) OVER e, 6) AS {c}_patient_mean, round(coalesce(stddev_samp({c}) OVER e, 0), 6) AS {c}_patient_std, "
    f"min({c}) OVER e AS {c}_patient_min, max({c}) OVER e AS {c}_patient_max"
    for c in _COLUMNS
)


@query("feature_table", f"WITH {VISITS} SELECT *, {_FEATURE_SQL}, {_FLAGS}, {_RISK} FROM visits WINDOW e AS (PARTITION BY patient_id)")
def feature_table(spark, sf):
    """The whole default feature job: 72 entity statistics, 13 flags and the risk score."""
    return rounded(featurize(visits(spark, sf)))


_EDUCATIONS = ("Bachelor's", "High School", "Master's", "PhD", "Some College")
_DUMMY_SQL = ", ".join(
    [f"CASE WHEN sex = '{v}' THEN 1 ELSE 0 END AS \"sex_{v}\"" for v in "FM"]
    + ["CASE WHEN education_level = '{}' THEN 1 ELSE 0 END AS \"education_level_{}\"".format(v.replace("'", "''"), v) for v in _EDUCATIONS]
)


@query("feature_table_with_history", f"""
WITH {VISITS}, v AS (SELECT * RENAME (patient_id AS entity_id, year AS period) FROM visits)
SELECT entity_id AS patient_id, period AS year, {_FEATURE_SQL}, {", ".join(rolling_sql(c) + ", " + delta_sql(c) for c in _COLUMNS)},
  sex, coalesce(education_level, 'unknown') AS education_level, {_DUMMY_SQL} FROM v WINDOW e AS (PARTITION BY entity_id)""")
def _(spark, sf):
    """All columns: entity statistics, rolling years, changes and dummies."""
    v = visits(spark, sf)
    wide = featurize(v, rolling_columns=_COLUMNS, lags=(1, 2), categorical=("sex", "education_level"))
    dummies = [f"sex_{x}" for x in "FM"] + [f"education_level_{x}" for x in _EDUCATIONS]
    names = P.feature_names(_COLUMNS, rolling_columns=_COLUMNS, lags=(1, 2))
    return rounded(wide.select("patient_id", "year", *names, "sex", "education_level", *[col(d) for d in dummies]))


def _mapped(spark, sf, chunk_size=None):
    import numpy as np

    from panelwise.functions.frames import map_frames

    def add(frame, base):
        frame["ratio"] = frame["bmi"] / base
        frame["band"] = np.where(frame["bmi"] >= 30, "obese", "other")
        return frame[["id", "ratio", "band"]]

    return rounded(map_frames(vitals(spark, sf).select("id", "bmi"), add, "id bigint, ratio double, band string", chunk_size, base=25.0))


_MAPPED_SQL = f"WITH {VITALS} SELECT id, round(bmi / 25, 6) AS ratio, CASE WHEN bmi >= 30 THEN 'obese' ELSE 'other' END AS band FROM vitals"


@query("k1_mapped_frames", _MAPPED_SQL)
def _(spark, sf):
    return _mapped(spark, sf)


@query("k1_mapped_chunks", _MAPPED_SQL)
def _(spark, sf):
    return _mapped(spark, sf, 700)
