"""Series cleaning (CLN) and its parameters (AG-20, AG-21, AG-31)."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators import clean, reshape, stats
from roadpulse.suite import views
from roadpulse.suite.registry import query, rounded, texts

_D = "strftime(date, '%Y-%m-%d') AS date"
_W = "WINDOW o AS (PARTITION BY region_slug ORDER BY date)"
BLACKOUT = (("1990-01-01", "1995-03-31"), ("1998-12-15", "1999-01-15"))
SEARCH = ("1995-03-31", "2000-12-15")
UNTIL = "2000-12-31"
_DARK = "(date <= DATE '1995-03-31' OR date BETWEEN DATE '1998-12-15' AND DATE '1999-01-15')"


def _series(spark, sf):
    return views.series(spark, sf)


def _out(df, digits=4):
    return rounded(texts(df), digits)


@query("cln01_validate", "sales", f"""
with one as (SELECT region_slug, date, min(amount) AS amount FROM sales GROUP BY ALL),
d as (SELECT region_slug, unnest(generate_series(min(date)::timestamp, max(date)::timestamp, INTERVAL 1 DAY))::date AS date FROM one GROUP BY 1)
SELECT d.region_slug, strftime(d.date, '%Y-%m-%d') AS date, one.amount FROM d LEFT JOIN one ON d.region_slug = one.region_slug AND d.date = one.date""")
def _(spark, sf):
    return texts(clean.validate(views.sales(spark, sf), "amount", regular=True))


@query("cln02_iqr_bounds", "series", f"""
SELECT region_slug, {_D}, observed, round(q1 - 1.5 * (q3 - q1), 4) AS low, round(q3 + 1.5 * (q3 - q1), 4) AS high FROM (
  SELECT *, quantile_cont(observed, 0.25) OVER r AS q1, quantile_cont(observed, 0.75) OVER r AS q3 FROM series WINDOW r AS (PARTITION BY region_slug))""")
def _(spark, sf):
    return _out(clean.iqr_bounds(_series(spark, sf), "observed", 1.5))


def _flag_cte(source: str, residual: str, name: str, c: str, into: str) -> str:
    """Size of a residual against its upper bound per region."""
    return f"""{into}_q as (SELECT region_slug, quantile_cont(abs({residual}), 0.25) AS q1, quantile_cont(abs({residual}), 0.75) AS q3 FROM {source} GROUP BY 1),
{into} as (SELECT s.*, coalesce(abs({residual}) > q3 + {c} * (q3 - q1), false) AS {name} FROM {source} s JOIN {into}_q USING (region_slug))"""


def _persist_cte(source, value, c, into):
    return f"""{into}_r as (SELECT *, CASE WHEN count(*) OVER p = 7 THEN {value} - quantile_cont({value}, 0.5) OVER p END AS pr FROM {source}
  WINDOW p AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
{_flag_cte(into + '_r', 'pr', 'anomaly_persist', c, into)}"""


def _pattern_cte(source, value, into):
    return f"""{into}_a as (SELECT *, (row_number() OVER (PARTITION BY region_slug ORDER BY date) - 1) % 7 AS ph,
    CASE WHEN count(*) OVER m = 7 THEN {value} - avg({value}) OVER m END AS off FROM {source}
  WINDOW m AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
{into}_b as (SELECT region_slug, ph, avg(off) AS pm FROM {into}_a GROUP BY 1, 2),
{into}_c as (SELECT region_slug, ph, pm - avg(pm) OVER (PARTITION BY region_slug) AS season FROM {into}_b),
{into} as (SELECT a.* EXCLUDE (off), season FROM {into}_a a JOIN {into}_c USING (region_slug, ph))"""


def _seasonal_cte(source, value, c, into):
    return f"""{_pattern_cte(source, value, into + '_p')},
{into}_r as (SELECT *, {value} - season AS se FROM {into}_p),
{_flag_cte(into + '_r', 'se', 'anomaly_seasonal', c, into)}"""


def _autor_cte(source, value, c, into):
    return f"""{into}_l as (SELECT *, lag({value}, 7) OVER (PARTITION BY region_slug ORDER BY date) AS past FROM {source}),
{into}_f as (SELECT region_slug, regr_slope({value}, past) AS sl, regr_intercept({value}, past) AS ic FROM {into}_l GROUP BY 1),
{into}_r as (SELECT l.*, {value} - (ic + sl * past) AS ar FROM {into}_l l JOIN {into}_f USING (region_slug)),
{_flag_cte(into + '_r', 'ar', 'anomaly_autor', c, into)}"""


@query("cln03_persist", "series", f"""
with {_persist_cte('series', 'observed', 3, 'f')} SELECT region_slug, {_D}, observed, anomaly_persist FROM f""")
def _(spark, sf):
    return _out(clean.persist(_series(spark, sf), "observed", 3.0))


@query("cln04_seasonal", "series", f"""
with {_seasonal_cte('series', 'observed', 1.5, 'f')} SELECT region_slug, {_D}, observed, anomaly_seasonal FROM f""")
def _(spark, sf):
    return _out(clean.seasonal(_series(spark, sf), "observed", 1.5))


@query("cln05_autoregression", "series", f"""
with {_autor_cte('series', 'observed', 1.5, 'f')} SELECT region_slug, {_D}, observed, anomaly_autor FROM f""")
def _(spark, sf):
    return _out(clean.autoregression(_series(spark, sf), "observed", 1.5))


@query("cln06_quantile", "series", f"""
with a as (SELECT *, isodow(date) AS dow FROM series), {_pattern_cte('a', 'observed', 'p')}
SELECT region_slug, {_D}, observed,
  observed < quantile_cont(observed, 0.01) OVER g OR observed > quantile_cont(observed, 0.99) OVER g AS by_dow,
  observed - season < quantile_cont(observed - season, 0.01) OVER r OR observed - season > quantile_cont(observed - season, 0.98) OVER r AS flat
FROM p WINDOW g AS (PARTITION BY region_slug, dow), r AS (PARTITION BY region_slug)""")
def _(spark, sf):
    df = _series(spark, sf).withColumn("dow", F.weekday("date") + 1)
    df = clean.quantile(df, "observed", 0.01, 0.99, ["region_slug", "dow"], name="by_dow")
    return _out(clean.quantile(df, "observed", 0.01, 0.98, deseason=True, name="flat").drop("dow"))


@query("ag31_outlier_rate", "series", """
with o as (SELECT *, isodow(date)::int AS dow FROM series),
f as (SELECT *, observed < quantile_cont(observed, 0.01) OVER g OR observed > quantile_cont(observed, 0.99) OVER g AS bad
  FROM o WINDOW g AS (PARTITION BY region_slug, dow))
SELECT region_slug, dow, count(*) AS n_obs, sum(bad::int)::bigint AS n_out, round(100.0 * sum(bad::int) / count(*), 6)::double AS pct_out FROM f GROUP BY ALL""")
def _(spark, sf):
    df = _series(spark, sf).withColumn("dow", F.weekday("date") + 1)
    flagged = clean.quantile(df, "observed", 0.01, 0.99, ["region_slug", "dow"])
    rate = stats.outlier_rate(flagged, ["region_slug", "dow"])
    return rounded(rate.withColumn("pct_out", F.col("pct_out").cast("double")))


_PAR = """
q as (SELECT region_slug, quantile_cont(observed, 0.01) AS q01, quantile_cont(observed, 0.05) AS q05, quantile_cont(observed, 0.25) AS q25,
  quantile_cont(observed, 0.75) AS q75, quantile_cont(observed, 0.95) AS q95, quantile_cont(observed, 0.99) AS q99 FROM series GROUP BY 1),
c4 as (SELECT region_slug, (q25 - q01) / (q75 - q25) AS a, (q99 - q75) / (q75 - q25) AS b, (q25 - q05) / (q75 - q25) AS c, (q95 - q75) / (q75 - q25) AS d FROM q),
cp as (SELECT region_slug, a AS c_low_p01, b AS c_upp_p99, c AS c_low_p05, d AS c_upp_p95, least(a, b, c, d) AS c_min,
  greatest(a, b, c, d) AS c_max, (a + b + c + d) / 4 AS c_avg, greatest(a, b, c, d) * 1.5 AS c_lsa, greatest(a, b, c, d) * 2 AS c_lsb,
  100.0::double AS c_lsc FROM c4)"""
_CCOLS = ["c_low_p01", "c_upp_p99", "c_low_p05", "c_upp_p95", "c_min", "c_max", "c_avg", "c_lsa", "c_lsb", "c_lsc"]
_CROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _CCOLS)


def _table(spark, sf):
    return clean.c_params(stats.quantile_profile(_series(spark, sf)))


@query("ag20_c_params", "series", f"with {_PAR} SELECT region_slug, {_CROUND} FROM cp")
def _(spark, sf):
    return rounded(_table(spark, sf))


@query("ag21_c_params_group_mean", "series", f"""
with {_PAR}, u as (SELECT * FROM cp UNION ALL SELECT 'old world', {', '.join(f'avg({c})' for c in _CCOLS)} FROM cp WHERE region_slug IN ('africa', 'asia', 'europe'))
SELECT region_slug, {_CROUND} FROM u""")
def _(spark, sf):
    return rounded(clean.c_params_group_mean(_table(spark, sf), ["africa", "asia", "europe"], "old world"))


@query("cln07_truncate_c", "series", f"with {_PAR} SELECT region_slug, round(least(greatest(c_max, 1.5), 3.0), 6) AS c, round(least(greatest(c_min, 1.5), 3.0), 6) AS d FROM cp")
def _(spark, sf):
    df = _table(spark, sf)
    return rounded(df.select("region_slug", clean.truncate_c(F.col("c_max")).alias("c"), clean.truncate_c(F.col("c_min")).alias("d")))


@query("cln08_c_param", "series", f"""
with {_PAR} SELECT s.region_slug, s.n, round(coalesce(c_max, 3.0) * 4, 6) AS c, 100.0::double AS off FROM (
  SELECT region_slug, count(*) AS n FROM series GROUP BY 1) s LEFT JOIN cp p ON p.region_slug = s.region_slug""")
def _(spark, sf):
    table = _table(spark, sf)
    df = _series(spark, sf).groupBy("region_slug").agg(F.count(F.lit(1)).alias("n"))
    return rounded(clean.c_param(clean.c_param(df, table, "max", 4.0), table, "max", 100.0, "off"))


def _vote_cte(source, value, c, into):
    return f"""{_persist_cte(source, value, c, into + '1')}, {_seasonal_cte(into + '1', value, c, into + '2')}, {_autor_cte(into + '2', value, c, into + '3')},
{into} as (SELECT *, CASE WHEN {_DARK} THEN 0 ELSE anomaly_persist::int + anomaly_seasonal::int + anomaly_autor::int END AS votes FROM {into}3)"""


def _votes(spark, sf):
    return clean.vote(_series(spark, sf), "observed", 2.0, BLACKOUT)


@query("cln09_vote", "series", f"""
with {_vote_cte('series', 'observed', 2.0, 'v')} SELECT region_slug, {_D}, observed, anomaly_persist, anomaly_seasonal, anomaly_autor, votes AS anomaly_sum FROM v""")
def _(spark, sf):
    return _out(_votes(spark, sf))


def _impute_sql(fn: str, name: str) -> str:
    return f"""
with {_vote_cte('series', 'observed', 2.0, 'v')}, m as (SELECT *, CASE WHEN votes < 1 AND observed >= 0 THEN observed END AS mv FROM v)
SELECT region_slug, {_D}, round(coalesce(mv, {fn} OVER (PARTITION BY region_slug ORDER BY date ROWS 29 PRECEDING)), 4) AS {name} FROM m"""


@query("cln10_impute_mean", "series", _impute_sql("avg(mv)", "rolling_mean"))
def _(spark, sf):
    return _out(clean.impute_mean(_votes(spark, sf), "observed").select("region_slug", "date", "rolling_mean"))


@query("cln10_impute_median", "series", _impute_sql("quantile_cont(mv, 0.5)", "rolling_median"))
def _(spark, sf):
    return _out(clean.impute_median(_votes(spark, sf), "observed").select("region_slug", "date", "rolling_median"))


# The bandwidth is found here by ranking all distances, not by the closed form.
def _lowess_cte(source, value, into, out="loess", votes="votes"):
    return f"""{into}_lo as (SELECT *, CASE WHEN {value} >= 0 THEN ln(1 + {value}) END AS y, row_number() OVER (PARTITION BY region_slug ORDER BY date) - 1 AS li,
  count(*) OVER (PARTITION BY region_slug) AS ln, NOT coalesce({votes} < 1 AND {value} >= 0, false) AS hole FROM {source}),
{_pattern_cte(into + '_lo', 'y', into + '_ls')},
{into}_dist as (SELECT h.region_slug, h.li, abs(l.li - h.li) AS d, row_number() OVER (PARTITION BY h.region_slug, h.li ORDER BY abs(l.li - h.li)) - 1 AS k, h.ln
  FROM (SELECT region_slug, li, ln FROM {into}_ls WHERE hole) h JOIN {into}_ls l ON l.region_slug = h.region_slug),
{into}_bw as (SELECT region_slug, li, d AS h FROM {into}_dist WHERE k = least(ceil(0.4 * ln), ln - 1)),
{into}_wt as (SELECT b.region_slug, b.li, (l.li - b.li) AS u, l.y - l.season AS f, (1 - (abs(l.li - b.li) / b.h::double) ** 3) ** 3 AS w
  FROM {into}_bw b JOIN {into}_ls l ON l.region_slug = b.region_slug AND abs(l.li - b.li) < b.h WHERE l.y IS NOT NULL),
{into}_fit as (SELECT region_slug, li, (sum(w * u * u) * sum(w * f) - sum(w * u) * sum(w * u * f)) / (sum(w) * sum(w * u * u) - sum(w * u) ** 2) AS fp FROM {into}_wt GROUP BY 1, 2),
{into} as materialized (SELECT l.* EXCLUDE (y, li, ln, ph, season, hole), CASE WHEN hole THEN exp(fp + season) - 1 ELSE {value} END AS {out}
  FROM {into}_ls l LEFT JOIN {into}_fit f ON f.region_slug = l.region_slug AND f.li = l.li)"""


_LOWESS = f"""{_vote_cte('series', 'observed', 2.0, 'v')},
vin as (SELECT region_slug, date, observed, votes FROM v), {_lowess_cte('vin', 'observed', 'lw')}"""


@query("cln11_impute_lowess", "series", f"with {_LOWESS} SELECT region_slug, {_D}, round(loess, 3) AS loess FROM lw")
def _(spark, sf):
    return _out(clean.impute_lowess(_votes(spark, sf), "observed").select("region_slug", "date", "loess"), 3)


def _change_cte(source, value, n, into):
    return f"""{into} as (SELECT region_slug, date, CASE WHEN count(*) OVER b = {n} AND count(*) OVER a = {n}
    THEN abs(quantile_cont({value}, 0.5) OVER a - quantile_cont({value}, 0.5) OVER b) END AS d, {n} AS n FROM {source}
  WINDOW b AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING),
    a AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING))"""


@query("cln12_level_shift", "series", f"""
with {_change_cte('series', 'observed', 14, 'x')}, {_flag_cte('x', 'd', 'shift', 3, 'f')}
SELECT region_slug, {_D}, shift FROM f""")
def _(spark, sf):
    return _out(clean.level_shift(_series(spark, sf), "observed", 14, 3.0).select("region_slug", "date", "shift"))


def _grid_cte(source, value, c, into):
    """Votes of the 25 combinations (``into``_v) and the chosen dates (``into``)."""
    ns = (14, 15, 16, 17, 18)
    return f"""{', '.join(_change_cte(source, value, n, f'{into}_x{n}') for n in ns)},
{into}_xs as ({' UNION ALL '.join(f'SELECT * FROM {into}_x{n}' for n in ns)}),
{into}_xq as (SELECT region_slug, n, quantile_cont(d, 0.25) AS q1, quantile_cont(d, 0.75) AS q3 FROM {into}_xs GROUP BY 1, 2),
{into}_c as (SELECT region_slug, any_value({c}) AS cc FROM {source} GROUP BY 1),
{into}_v as (SELECT region_slug, date, sum((d > q3 + (q3 - q1) * round(cc * f, 4))::int)::int AS shift_sum
  FROM {into}_xs JOIN {into}_xq USING (region_slug, n) JOIN {into}_c USING (region_slug), (VALUES (0.4), (0.8), (1.0), (1.2), (1.6)) AS g(f)
  WHERE date > DATE '{SEARCH[0]}' AND date < DATE '{SEARCH[1]}' GROUP BY 1, 2 HAVING shift_sum > 0),
{into} as (SELECT region_slug, min_by(date, (-shift_sum, date)) AS shift_date FROM {into}_v GROUP BY 1)"""


def _correct_cte(source, value, dates, out, into, days=7, until=UNTIL):
    """Move the rows after the shift, then bridge negatives by straight lines."""
    limit = f"AND date <= DATE '{until}'" if until else ""
    return f"""{into}_dl as (SELECT s.region_slug, shift_date, avg({value}) FILTER (date > shift_date - {days} AND date <= shift_date)
    - avg({value}) FILTER (date > shift_date AND date <= shift_date + {days}) AS delta FROM {source} s JOIN {dates} USING (region_slug) GROUP BY 1, 2),
{into}_mv as (SELECT s.*, shift_date AS sdate, CASE WHEN date > shift_date {limit} AND delta IS NOT NULL THEN {value} + delta ELSE {value} END AS moved
  FROM {source} s LEFT JOIN {into}_dl USING (region_slug)),
{into}_p as (SELECT *, CASE WHEN moved >= 0 THEN moved END AS iv, row_number() OVER (PARTITION BY region_slug ORDER BY date) AS ii FROM {into}_mv),
{into}_q as (
  SELECT *, last_value(iv IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN iv IS NOT NULL THEN ii END IGNORE NULLS) OVER b AS i0,
    first_value(iv IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN iv IS NOT NULL THEN ii END IGNORE NULLS) OVER a AS i1
  FROM {into}_p WINDOW b AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY region_slug ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{into} as materialized (SELECT * EXCLUDE (moved, iv, ii, v0, i0, v1, i1), coalesce(iv, v0 + (v1 - v0) * (ii - i0) / (i1 - i0), v0) AS {out} FROM {into}_q)"""


def _step_cte(source, target, c, c_shift, output, into):
    """One cleaning step: adds ``into``_loess, ``output`` and the two flags."""
    keep = f"anomaly_persist, anomaly_seasonal, anomaly_autor, pr, se, ar, past, season, ph"
    return f"""{_vote_cte(source, target, c, into + '_vt')},
{into}_in as materialized (SELECT * EXCLUDE ({keep}) FROM {into}_vt),
{_lowess_cte(into + '_in', target, into + '_lw', into + '_loess')},
{_grid_cte(into + '_lw', into + '_loess', c_shift, into + '_sd')},
{_correct_cte(into + '_lw', into + '_loess', into + '_sd', output, into + '_co')},
{into} as materialized (SELECT * EXCLUDE (votes, sdate), votes >= 1 AS {into}_outliers, coalesce(date = sdate, false) AS {into}_level_shifts FROM {into}_co)"""


_GRID = _grid_cte("series", "observed", "2.0", "sd")


def _shift_votes(spark, sf):
    return clean.shift_votes(_series(spark, sf), "observed", 2.0, SEARCH)


@query("cln13_shift_votes", "series", f"with {_GRID} SELECT region_slug, {_D}, shift_sum FROM sd_v")
def _(spark, sf):
    return texts(_shift_votes(spark, sf))


@query("cln14_shift_date", "series", f"with {_GRID} SELECT region_slug, strftime(shift_date, '%Y-%m-%d') AS shift_date FROM sd")
def _(spark, sf):
    return texts(clean.shift_date(_shift_votes(spark, sf)))


@query("cln15_correct_shift", "series", f"""
with {_GRID}, {_correct_cte('series', 'observed', 'sd', 'shifted', 'co')}
SELECT region_slug, {_D}, round(shifted, 4) AS shifted FROM co""")
def _(spark, sf):
    dates = clean.shift_date(_shift_votes(spark, sf))
    df = clean.correct_shift(_series(spark, sf), "observed", dates, until=UNTIL)
    return _out(df.select("region_slug", "date", "shifted"))


def _round_cte(source, into):
    """First flagged date of each region, corrected over 14 days each side."""
    return f"""{_change_cte(source, 'cur', 14, into + '_x')}, {_flag_cte(into + '_x', 'd', 'shift', 3, into + '_f')},
{into}_sd as materialized (SELECT region_slug, min(date) AS shift_date FROM {into}_f WHERE shift GROUP BY 1),
{_correct_cte(source, 'cur', into + '_sd', 'nxt', into + '_c', 14, None)},
{into} as (SELECT region_slug, date, observed, nxt AS cur FROM {into}_c)"""


# More rounds than the series need: a round without a shift changes nothing.
ROUNDS = 6


@query("cln16_correct_all_shifts", "series", f"""
with r0 as (SELECT *, observed AS cur FROM series), {', '.join(_round_cte(f'r{k}', f'r{k + 1}') for k in range(ROUNDS))}
SELECT region_slug, {_D}, observed, round(cur, 4) AS shifted,
  region_slug NOT IN (SELECT region_slug FROM r{ROUNDS}_sd) AS settled FROM r{ROUNDS}""")
def _(spark, sf):
    return _out(clean.correct_all_shifts(_series(spark, sf), "observed", 3.0))


def _index(spark, sf):
    """Series with the mean of the same weekday over the first two years as expectation."""
    df = _series(spark, sf).withColumn("dow", F.weekday("date") + 1)
    base = df.where("date < DATE '1997-01-01'").groupBy("region_slug", "dow").agg(F.round(F.avg("observed"), 2).alias("expected_2020"))
    change = (F.try_divide("observed", "expected_2020") - 1) * 100
    return df.join(base, ["region_slug", "dow"]).withColumn("tcp", change).withColumn(
        "region_type", F.when(F.col("region_slug") == "asia", "country").otherwise("city"))


def _cleaned(spark, sf):
    return clean.run(
        _index(spark, sf), _table(spark, sf), "max", {"country": 1.0, "city": 100.0},
        blackout=BLACKOUT, search=SEARCH, until=UNTIL,
    )


@query("cln17_step", "series", f"""
with {_step_cte('series', 'observed', '3.0', '1.0', 's1_shift', 's1')}
SELECT region_slug, {_D}, observed, round(s1_loess, 3) AS loess, round(s1_shift, 3) AS s1_shift, s1_outliers AS outliers, s1_level_shifts AS level_shifts FROM s1""")
def _(spark, sf):
    return _out(clean.step(_series(spark, sf), "observed", "s1_shift", 3.0, 1.0, BLACKOUT, SEARCH, UNTIL), 3)


@query("cln18_run", "series", f"""
with {_PAR},
ib as (SELECT region_slug, isodow(date) AS dow, round(avg(observed), 2) AS expected_2020 FROM series WHERE date < DATE '1997-01-01' GROUP BY ALL),
ix as (SELECT s.region_slug, s.date, s.observed, expected_2020, c_max AS c1, CASE WHEN s.region_slug = 'asia' THEN c_max ELSE 100.0 END AS c2
  FROM series s JOIN ib ON ib.region_slug = s.region_slug AND ib.dow = isodow(s.date) JOIN cp ON cp.region_slug = s.region_slug),
{_step_cte('ix', 'observed', 'least(greatest(c1, 1.5), 3.0)', 'c2', 's1_shift', 's1')},
{_step_cte('s1', 's1_shift', 'least(greatest(c1, 1.5), 3.0)', 'c2', 's2_shift', 's2')}
SELECT region_slug, {_D}, observed, expected_2020, round(s1_loess, 2) AS s1_loess, round(s1_shift, 2) AS s1_shift, round(s2_loess, 2) AS s2_loess,
  round(s2_shift, 2) AS s2_shift, round(100 * (s2_shift - expected_2020) / expected_2020, 4) AS tcp_smooth, round(s2_shift, 2) AS tci_smooth,
  s1_outliers, s1_level_shifts, s2_outliers, s2_level_shifts FROM s2""")
def _(spark, sf):
    df = texts(_cleaned(spark, sf).drop("dow", "tcp", "region_type"))
    return rounded(rounded(df, 2, ("s1_loess", "s1_shift", "s2_loess", "s2_shift", "tci_smooth")), 4)


@query("cln18_run_flags", "series", f"""
with cp as (SELECT region_slug, least(greatest(greatest((q25 - q01) / (q75 - q25), (q99 - q75) / (q75 - q25), (q25 - q05) / (q75 - q25), (q95 - q75) / (q75 - q25)), 1.5), 3.0) AS c FROM (
  SELECT region_slug, quantile_cont(observed, 0.01) AS q01, quantile_cont(observed, 0.05) AS q05, quantile_cont(observed, 0.25) AS q25,
  quantile_cont(observed, 0.75) AS q75, quantile_cont(observed, 0.95) AS q95, quantile_cont(observed, 0.99) AS q99 FROM series GROUP BY 1)),
sc as (SELECT series.*, c FROM series JOIN cp USING (region_slug)),
{_vote_cte('sc', 'observed', 'c', 'v')}
SELECT region_slug, {_D}, observed, votes >= 1 AS s1_outliers FROM v""")
def _(spark, sf):
    return texts(_cleaned(spark, sf).select("region_slug", "date", "observed", "s1_outliers"))


@query("cln19_weekly", "series", """
with d as (SELECT *, isodow(date)::int AS dow FROM series),
b as (SELECT region_slug, dow, round(avg(observed), 2) AS e FROM d WHERE date < DATE '1997-01-01' GROUP BY ALL),
w as (SELECT d.*, e, sum(CASE WHEN dow = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY region_slug ORDER BY date) AS week FROM d JOIN b USING (region_slug, dow))
SELECT region_slug, week::bigint AS week, min(year(date))::int AS year, strftime(min(date), '%Y-%m-%d') AS date_min, strftime(max(date), '%Y-%m-%d') AS date_max,
  count(*) AS days_num, round(sum(observed), 2) AS observed, round(sum(observed - 1000), 2) AS cleaned, round(sum(e), 2) AS expected_2020,
  round(100 * (sum(observed) - sum(e)) / sum(e), 4) AS tcp, round(100 * (sum(observed - 1000) - sum(e)) / sum(e), 4) AS tcp_clean FROM w GROUP BY 1, 2""")
def _(spark, sf):
    df = clean.weekly(_index(spark, sf).withColumn("s2_shift", F.col("observed") - 1000))
    return rounded(rounded(texts(df), 2, ("observed", "cleaned", "expected_2020")), 4)


@query("cln20_anomaly_log", "series", f"""
with {_vote_cte('series', 'observed', 2.0, 'v')}
SELECT region_slug, {_D}, 's1' AS step, 'outliers' AS kind FROM v WHERE votes >= 1
UNION ALL SELECT region_slug, {_D}, 's2', 'level_shifts' FROM v WHERE votes >= 2""")
def _(spark, sf):
    none = F.lit(False)
    df = _votes(spark, sf).select(
        "region_slug", "date", (F.col("anomaly_sum") >= 1).alias("s1_outliers"), none.alias("s1_level_shifts"),
        none.alias("s2_outliers"), (F.col("anomaly_sum") >= 2).alias("s2_level_shifts"))
    return texts(clean.anomaly_log(df))


@query("cln21_compare_runs", "series", f"""
SELECT region_slug, {_D}, observed AS observed_1X, least(observed, 400000.0) AS observed_4X, least(observed, 300000.0) AS observed_OFF FROM series
WHERE observed > 60000""")
def _(spark, sf):
    df = texts(_series(spark, sf))
    runs = {
        "1X": df.where("observed > 60000"),
        "4X": df.withColumn("observed", F.least("observed", F.lit(400000.0))),
        "OFF": df.withColumn("observed", F.least("observed", F.lit(300000.0))),
    }
    return reshape.compare_runs(runs, ["region_slug", "date"], ["observed"])
