"""SQL (DuckDB dialect) builders for the model oracles: the re-aimed data
sets, unrolled gradient descent, naive Bayes and curve areas."""

from __future__ import annotations

from .text_plans import _TF_SQL

PAGES_SQL = """
pc AS (
  SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, d.source AS category,
         d.n_chars / 1000.0 AS x0,
         len(list_filter(string_split(d.text, ' '), lambda t: t <> '')) / 100.0 AS x1,
         len(string_split(d.text, chr(10))) / 10.0 AS x2,
         d.n_chars / greatest(len(list_filter(string_split(d.text, ' '), lambda t: t <> '')), 1) / 10.0 AS x3
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

HOURLY_SQL = """
hd AS (
  SELECT date_trunc('hour', ts) AS hour_start, CAST(count(*) AS DOUBLE) AS cnt FROM events GROUP BY 1),
hdf AS (
  SELECT hour_start, hour(hour_start) AS hr, dayofweek(hour_start) AS weekday, dayofmonth(hour_start) AS day, cnt,
         hour(hour_start) / 23.0 AS x0, dayofweek(hour_start) / 6.0 AS x1,
         CASE WHEN dayofweek(hour_start) IN (0, 6) THEN 1.0 ELSE 0.0 END AS x2,
         dayofmonth(hour_start) / 31.0 AS x3, cnt AS label
  FROM hd)"""


def gd_ctes(data: str, d: int, loss: str, step: float, iters: int, reg: str, lam: float,
            intercept: bool, prefix: str = "w") -> str:
    """CTEs w0..w{iters}, each one row with weights a0..a{D-1}; ``data`` is a
    relation with columns x0..x{d-1}, label."""
    D = d + (1 if intercept else 0)
    xs = [f"x{j}" for j in range(d)] + (["1.0"] if intercept else [])
    init = ["0.0"] * d + (["1.0"] if intercept else [])
    ctes = [f"{prefix}0 AS MATERIALIZED (SELECT " + ", ".join(f"{init[j]}::DOUBLE AS a{j}" for j in range(D)) + ")"]
    for i in range(1, iters + 1):
        p = f"{prefix}{i - 1}"
        m = " + ".join(f"{p}.a{j} * {xs[j]}" for j in range(D))
        if loss == "logistic":
            err = f"(1.0 / (1.0 + exp(-({m}))) - label)"
        elif loss == "hinge":
            err = f"(CASE WHEN (2.0 * label - 1.0) * ({m}) < 1.0 THEN -(2.0 * label - 1.0) ELSE 0.0 END)"
        else:
            err = f"(({m}) - label)"
        grads = ", ".join(f"avg({err} * {xs[j]}) AS g{j}" for j in range(D))
        eta = f"({step} / sqrt({i}))"
        ups = []
        for j in range(D):
            if reg == "none":
                u = f"{p}.a{j} - {eta} * g.g{j}"
            elif reg == "l2":
                u = f"{p}.a{j} * (1.0 - {eta} * {lam}) - {eta} * g.g{j}"
            else:
                v = f"({p}.a{j} - {eta} * g.g{j})"
                u = f"sign({v}) * greatest(0.0, abs({v}) - {eta} * {lam})"
            ups.append(f"{u} AS a{j}")
        ctes.append(f"{prefix}{i} AS MATERIALIZED (SELECT {', '.join(ups)} FROM (SELECT {grads} FROM {data}, {p}) g, {p})")
    return ",\n".join(ctes)


def sweep_ctes(grid: list[tuple[str, object, dict]], train: str, d: int) -> str:
    """CTEs ``cfg`` (one row per grid entry) and ``fw`` (its weights a0..a{d}
    after its iterations, a{d} the intercept): the same descent as ``gd_ctes``
    as one recursion over the iterations. All entries share one loss."""
    loss = grid[0][2]["loss"]
    values = ", ".join(
        f"({k}, '{name}', {float(v)}::DOUBLE, {float(c['step'])}::DOUBLE, {c['iters']}, '{c['reg']}', "
        f"{float(c['reg_param'])}::DOUBLE, {1.0 if c['intercept'] else 0.0}::DOUBLE)"
        for k, (name, v, c) in enumerate(grid))
    a = [f"a{j}" for j in range(d + 1)]
    xs = [f"x{j}" for j in range(d)] + ["icpt"]
    m = " + ".join(f"{w} * {x}" for w, x in zip(a, xs))
    err = f"(1.0 / (1.0 + exp(-({m}))) - label)" if loss == "logistic" else f"(({m}) - label)"
    grads = ", ".join(f"avg({err} * {x}) AS g{j}" for j, x in enumerate(xs))
    eta = "(step / sqrt(i + 1))"
    ups = ", ".join(
        f"CASE reg WHEN 'l1' THEN sign({w} - {eta} * g{j}) * greatest(0.0, abs({w} - {eta} * g{j}) - {eta} * lam) "
        f"WHEN 'l2' THEN {w} * (1.0 - {eta} * lam) - {eta} * g{j} ELSE {w} - {eta} * g{j} END"
        for j, w in enumerate(a))
    cols = ", ".join(a)
    return f"""cfg(id, param, value, step, iters, reg, lam, icpt) AS (VALUES {values}),
gw AS (
  SELECT id, 0 AS i, {", ".join(f"0.0::DOUBLE AS a{j}" for j in range(d))}, icpt AS a{d} FROM cfg
  UNION ALL
  SELECT id, i + 1, {ups}
  FROM (SELECT gw.id, gw.i, {cols}, step, reg, lam, {grads}
        FROM gw JOIN cfg ON gw.id = cfg.id CROSS JOIN {train} WHERE gw.i < cfg.iters
        GROUP BY gw.id, gw.i, {cols}, step, reg, lam) g),
fw AS (SELECT cfg.id, param, value, icpt, {cols} FROM gw JOIN cfg ON gw.id = cfg.id AND gw.i = cfg.iters)"""


def weights_select(name: str, w: str, D: int) -> str:
    parts = [f"SELECT '{name}' AS model, {j} AS j, round(a{j}, 6) AS weight, a{j} = 0 AS is_zero FROM {w}"
             for j in range(D)]
    return "\nUNION ALL ".join(parts)


def margin_sql(w: str, d: int, intercept: bool) -> str:
    m = " + ".join(f"{w}.a{j} * x{j}" for j in range(d))
    return m + (f" + {w}.a{d}" if intercept else "")


def areas_sql(scored: str) -> str:
    """Area under ROC / PR of a relation (score, label) as one row."""
    return f"""(
WITH per AS (SELECT CAST(score AS DOUBLE) AS s, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS tp,
                    sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS fp FROM {scored} GROUP BY 1),
tot AS (SELECT sum(tp) AS P, sum(fp) AS N FROM per),
cum AS (SELECT s, sum(tp) OVER (ORDER BY s DESC) AS ctp, sum(fp) OVER (ORDER BY s DESC) AS cfp FROM per),
pts AS (SELECT s, cfp / N AS fpr, ctp / P AS tpr, ctp / (ctp + cfp) AS prec FROM cum, tot),
seg AS (SELECT s, fpr, tpr, prec,
               coalesce(lag(fpr) OVER (ORDER BY s DESC), 0.0) AS pf,
               coalesce(lag(tpr) OVER (ORDER BY s DESC), 0.0) AS pt,
               coalesce(lag(prec) OVER (ORDER BY s DESC), prec) AS pp FROM pts),
lst AS (SELECT arg_min(fpr, s) AS lf, arg_min(tpr, s) AS lt FROM pts)
SELECT sum((fpr - pf) * (tpr + pt) / 2) + (SELECT (1.0 - lf) * (1.0 + lt) / 2 FROM lst) AS area_under_roc,
       sum((tpr - pt) * (prec + pp) / 2) AS area_under_pr
FROM seg)"""


def nb_scores_sql(docs: str, long: str, n_features: str, smoothing: float) -> str:
    """CTEs ending in ``nbpred(doc_id, label, prediction)``; ``docs`` has
    (doc_id, label), ``long`` has (doc_id, j, x)."""
    s = smoothing
    return f"""
nbc AS (SELECT label, count(*) AS n_c FROM {docs} GROUP BY label),
nbs AS (SELECT d.label, l.j, sum(l.x) AS S FROM {long} l JOIN {docs} d ON l.doc_id = d.doc_id GROUP BY d.label, l.j),
nbt AS (SELECT nbc.label, nbc.n_c, coalesce((SELECT sum(S) FROM nbs WHERE nbs.label = nbc.label), 0) AS T FROM nbc),
nbp AS (SELECT label, ln((n_c + {s}) / ((SELECT sum(n_c) FROM nbc) + {s} * (SELECT count(*) FROM nbc))) AS prior,
               ln(T + {s} * ({n_features})) AS logden FROM nbt),
nbx AS (SELECT d.doc_id, p.label AS cls,
               p.prior + coalesce(sum(l.x * (ln(coalesce(s2.S, 0) + {s}) - p.logden)), 0) AS score
        FROM {docs} d CROSS JOIN nbp p
        LEFT JOIN {long} l ON l.doc_id = d.doc_id
        LEFT JOIN nbs s2 ON s2.j = l.j AND s2.label = p.label
        GROUP BY d.doc_id, p.label, p.prior),
nbpred AS (SELECT d.doc_id, d.label, arg_max(x.cls, struct_pack(sc := x.score, nc := -x.cls)) AS prediction
           FROM {docs} d JOIN nbx x ON d.doc_id = x.doc_id GROUP BY d.doc_id, d.label)"""


TEXT_NB_SQL = f"""
{_TF_SQL},
tdocs AS (SELECT doc_id, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS DOUBLE) AS label FROM documents),
vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS j FROM (SELECT DISTINCT term FROM tf)),
tlong AS (SELECT tf.doc_id, vocab.j, CAST(tf.tf AS DOUBLE) AS x FROM tf JOIN vocab ON tf.term = vocab.term)"""
