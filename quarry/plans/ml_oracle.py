"""DuckDB SQL for the sampling, feature and clustering queries SQL can express."""

from __future__ import annotations

from quarry.functions.hashing import HEX_DIGITS, SCALE
from quarry.operators.features import COVER_TYPES
from quarry.plans import ml_queries as Q
from quarry.plans.series_oracle import SERIES

D = Q.DEC


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def u_sql(*parts: str) -> str:
    """Same hash uniform as quarry.functions.hashing.hash_uniform."""
    joined = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return (f"(CAST(('0x' || substr(md5(concat_ws('|', {joined})), 1, {HEX_DIGITS}))::BIGINT AS DOUBLE)"
            f" / {SCALE!r})")


LINE_KEY = "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))"


def split_sql(key: str, salt: str, weights=(0.7, 0.3), names=("train", "test")) -> str:
    total = float(sum(weights))
    acc, parts = 0.0, []
    for w, n in zip(weights[:-1], names[:-1]):
        acc += w / total
        parts.append(f"WHEN {u_sql(key, lit(salt))} < {acc!r} THEN {lit(n)}")
    return f"CASE {' '.join(parts)} ELSE {lit(names[-1])} END"


def sqd(a: str, b: str) -> str:
    return f"list_sum([({a}[i] - {b}[i]) * ({a}[i] - {b}[i]) for i in range(1, len({a}) + 1)])"


PTS = "pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings)"


def seeds_ctes() -> str:
    ctes = [PTS, f"cand AS (SELECT r.range AS run, p.id, p.vec FROM pts p CROSS JOIN range(0, {Q.RUNS}) r)"]
    for t in range(Q.K):
        u = u_sql("id", "run", str(t), str(Q.KMEANS_SEED))
        if t == 0:
            ctes.append(f"""r0 AS (SELECT run, 0 AS j, id, vec FROM (
  SELECT run, id, vec, row_number() OVER (PARTITION BY run ORDER BY u, u, id) AS rn
  FROM (SELECT *, {u} AS u FROM cand)) WHERE rn = 1)""")
        else:
            chosen = " UNION ALL ".join(f"SELECT * FROM r{s}" for s in range(t))
            ctes.append(f"""d{t} AS (SELECT c.run, c.id, c.vec, min({sqd('c.vec', 's.vec')}) AS d2
  FROM cand c JOIN ({chosen}) s ON c.run = s.run GROUP BY c.run, c.id, c.vec)""")
            ctes.append(f"""r{t} AS (SELECT run, {t} AS j, id, vec FROM (
  SELECT run, id, vec, row_number() OVER (PARTITION BY run ORDER BY
    CASE WHEN d2 > 0 THEN -ln(u) / d2 ELSE 'inf'::DOUBLE END, u, id) AS rn
  FROM (SELECT *, {u} AS u FROM d{t})) WHERE rn = 1)""")
    ctes.append("seeds AS (" + " UNION ALL ".join(f"SELECT * FROM r{t}" for t in range(Q.K)) + ")")
    ctes.append(f"""near AS (SELECT id, run, j, d2 FROM (
  SELECT p.id, s.run, s.j, {sqd('p.vec', 's.vec')} AS d2,
         row_number() OVER (PARTITION BY p.id, s.run ORDER BY {sqd('p.vec', 's.vec')}, s.j) AS rn
  FROM pts p CROSS JOIN seeds s) WHERE rn = 1)""")
    return "WITH " + ",\n".join(ctes) + "\n"


SEEDS = seeds_ctes()

DECODE = "CASE label " + " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in COVER_TYPES.items()) + " END"

PARTICLE_FEATURES_SQL = ("[l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE), "
                         "CAST(dayofyear(l_shipdate) AS DOUBLE), CAST(year(l_shipdate) AS DOUBLE)]")

_A, _B = Q.DERIVE_PAIR
_C1, _C2, _C3 = Q.CONCAT_MEASUREMENTS

def linreg_gram_sql() -> str:
    key = LINE_KEY
    xs = ["1.0", "l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)"]
    disc = "(l_extendedprice * (1 - l_discount))"
    ys = ["l_extendedprice", disc, f"({disc} * (1 + l_tax))"]
    terms = []
    for i in range(len(xs)):
        for j in range(i, len(xs)):
            terms.append((f"xx_{i}_{j}", f"sum(CAST({xs[i]} AS DOUBLE) * {xs[j]})"))
        for t in range(len(ys)):
            terms.append((f"xy_{i}_{t}", f"sum(CAST({xs[i]} AS DOUBLE) * {ys[t]})"))
    for t in range(len(ys)):
        terms.append((f"yy_{t}", f"sum({ys[t]} * {ys[t]})"))
    cols = ", ".join(f"{expr} AS {name}" for name, expr in terms)
    unpivot = " UNION ALL ".join(f"SELECT split, '{name}' AS term, {name} AS v FROM g" for name, _ in terms)
    d = Q.SIG_DIGITS - 1
    return f"""WITH d AS (SELECT *, {split_sql(key, 'half', (0.5, 0.5))} AS split FROM lineitem),
g AS (SELECT split, {cols} FROM d GROUP BY split),
u AS ({unpivot}),
e AS (SELECT split, term, v, CASE WHEN v <> 0 THEN CAST(floor(log10(abs(v))) AS INTEGER) ELSE 0 END AS exponent FROM u)
SELECT split, term, exponent, round(v / pow(10.0, exponent), {d}) AS mantissa FROM e"""


def linreg_ctes() -> str:
    """Means and centred co-moments per split, and the slopes of every set of inputs by Gauss-Jordan elimination."""
    xs = ["l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)"]
    disc = "(l_extendedprice * (1 - l_discount))"
    ys = ["l_extendedprice", disc, f"({disc} * (1 + l_tax))"]
    nx, ny = range(len(xs)), range(len(ys))
    cols = [f"{c} AS x{i}" for i, c in enumerate(xs)] + [f"{c} AS y{t}" for t, c in enumerate(ys)]
    stats = ([f"avg(x{i}) AS mx{i}" for i in nx] + [f"avg(y{t}) AS my{t}" for t in ny] + [f"var_pop(y{t}) AS vy{t}" for t in ny]
             + [f"covar_pop(x{min(i, j)}, x{max(i, j)}) AS s{i}_{j}" for i in nx for j in nx]
             + [f"covar_pop(x{i}, y{t}) AS c{i}_{t}" for i in nx for t in ny])
    ctes = [f"d AS (SELECT {', '.join(cols)}, {split_sql(LINE_KEY, 'half', (0.5, 0.5))} AS split FROM lineitem)",
            f"m AS (SELECT split, {', '.join(stats)} FROM d GROUP BY split)"]
    for out in (None, *nx):
        own = [i for i in nx if i != out]
        name = f"f{'' if out is None else out}"
        ctes.append(f"{name}_0 AS (SELECT {', '.join([f's{i}_{j} AS a{i}_{j}' for i in own for j in own] + [f'c{i}_{t} AS b{i}_{t}' for i in own for t in ny])} "
                    "FROM m WHERE split = 'train')")
        for step, k in enumerate(own):
            terms = []
            for i in own:
                for c in [f"a{{0}}_{j}" for j in own] + [f"b{{0}}_{t}" for t in ny]:
                    here = c.format(i)
                    terms.append(here if i == k else f"{here} - a{i}_{k} / a{k}_{k} * {c.format(k)} AS {here}")
            ctes.append(f"{name}_{step + 1} AS (SELECT {', '.join(terms)} FROM {name}_{step})")
        slopes = [f"b{i}_{t} / a{i}_{i} AS w{i}_{t}" for i in own for t in ny] + [f"0.0 AS w{out}_{t}" for t in ny if out is not None]
        ctes.append(f"{name} AS (SELECT {', '.join(slopes)} FROM {name}_{len(own)})")
        errors = []
        for t in ny:
            off = f"((m.my{t} - b.my{t})" + "".join(f" - w{i}_{t} * (m.mx{i} - b.mx{i})" for i in nx) + ")"
            sse = (f"m.vy{t}" + "".join(f" - 2 * w{i}_{t} * m.c{i}_{t}" for i in nx)
                   + "".join(f" + w{i}_{t} * w{j}_{t} * m.s{i}_{j}" for i in nx for j in nx) + f" + {off} * {off}")
            errors.append(f"1 - ({sse}) / m.vy{t} AS r{t}")
        ctes.append(f"r{'' if out is None else out} AS (SELECT m.split, {', '.join(errors)} FROM m, {name}, (SELECT * FROM m WHERE split = 'train') b)")
    return "WITH " + ",\n".join(ctes) + "\n"


def linreg_fit_sql() -> str:
    rows = []
    for t, y in enumerate(Q.REGRESSION_TARGETS):
        centre = f"my{t}" + "".join(f" - w{i}_{t} * mx{i}" for i in range(len(Q.REGRESSION_INPUTS)))
        rows.append(f"SELECT '{y}' AS target, 'intercept' AS feature, round({centre}, {Q.COEF_DEC}) AS coef FROM f, m WHERE split = 'train'")
        rows += [f"SELECT '{y}', '{x}', round(w{i}_{t}, {Q.COEF_DEC}) FROM f" for i, x in enumerate(Q.REGRESSION_INPUTS)]
    return linreg_ctes() + " UNION ALL ".join(rows)


def _both_splits(table: str, t: int) -> tuple[str, str]:
    return tuple(f"(SELECT r{t} FROM {table} WHERE split = '{s}')" for s in ("train", "test"))


def linreg_score_sql() -> str:
    rows = []
    for t, y in enumerate(Q.REGRESSION_TARGETS):
        a, b = _both_splits("r", t)
        rows.append(f"SELECT '{y}' AS target, round({a}, {D}) AS r2_train, round({b}, {D}) AS r2_test")
    return linreg_ctes() + " UNION ALL ".join(rows)


def linreg_ablation_sql() -> str:
    rows = []
    for t, y in enumerate(Q.REGRESSION_TARGETS):
        a, b = _both_splits("r", t)
        for i, x in enumerate(Q.REGRESSION_INPUTS):
            c, d = _both_splits(f"r{i}", t)
            rows.append(f"SELECT '{y}' AS target, '{x}' AS removed, round({a} - {c}, {D}) AS drop_train, round({b} - {d}, {D}) AS drop_test")
    return linreg_ctes() + " UNION ALL ".join(rows)


# Lloyd steps for all runs from the seeds, until the largest shift of a run is small enough.
LLOYD = SEEDS.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
steps(step, run, j, vec, shift) AS (
  SELECT 0, CAST(run AS INTEGER), CAST(j AS INTEGER), vec, CAST('inf' AS DOUBLE) FROM seeds
  UNION ALL
  SELECT step + 1, run, j, vec, max(moved) OVER () FROM (
    SELECT step, run, j, new AS vec, sum(sqrt({sqd('old', 'new')})) OVER (PARTITION BY run) AS moved FROM (
      SELECT c.step, c.run, c.j, c.vec AS old, coalesce(m.vec, c.vec) AS new
      FROM (SELECT * FROM steps WHERE shift > {Q.CONVERGE}) c
      LEFT JOIN (
        SELECT run, j, list(mean ORDER BY dim) AS vec FROM (
          SELECT a.run, a.j, d.dim, avg(a.vec[d.dim]) AS mean FROM (
            SELECT p.id, p.vec, c.run, c.j, row_number() OVER (PARTITION BY p.id, c.run ORDER BY {sqd('p.vec', 'c.vec')}, c.j) AS rn
            FROM pts p CROSS JOIN (SELECT * FROM steps WHERE shift > {Q.CONVERGE}) c) a
          CROSS JOIN range(1, 65) d(dim) WHERE a.rn = 1 GROUP BY a.run, a.j, d.dim)
        GROUP BY run, j) m ON m.run = c.run AND m.j = c.j))),
final AS MATERIALIZED (SELECT run, j, vec FROM steps WHERE step = (SELECT max(step) FROM steps)),
best AS MATERIALIZED (SELECT id, run, j, d2 FROM (
  SELECT p.id, c.run, c.j, {sqd('p.vec', 'c.vec')} AS d2, row_number() OVER (PARTITION BY p.id, c.run ORDER BY {sqd('p.vec', 'c.vec')}, c.j) AS rn
  FROM pts p CROSS JOIN final c) WHERE rn = 1),
cost AS MATERIALIZED (SELECT run, sum(d2) AS cost FROM best GROUP BY run)
"""

RULE = f"""WITH p AS (SELECT {LINE_KEY} AS key, {split_sql(LINE_KEY, 'split')} AS split, CAST(l_returnflag = 'R' AS DOUBLE) AS label,
  CAST(year(l_shipdate) <= {Q.RULE_YEAR} AS DOUBLE) AS prediction FROM lineitem)
"""

ORACLE = {
    "linreg_fit": linreg_fit_sql(),
    "linreg_score": linreg_score_sql(),
    "linreg_ablation": linreg_ablation_sql(),
    "kmeans_multi": LLOYD + f"SELECT run, j, list_transform(vec, lambda x: round(x, {D})) AS center FROM final",
    "max_shift": LLOYD + f"SELECT DISTINCT step AS iteration, round(shift, {D}) AS max_shift FROM steps WHERE step > 0",
    "kmeans_assign": LLOYD + "SELECT id AS vec_id, list(j ORDER BY run) AS labels FROM best GROUP BY id",
    "run_cost": LLOYD + f"SELECT run, round(cost, {D}) AS cost FROM cost",
    "cost_summary": LLOYD + f"""SELECT round(log2(max(cost)), {D}) AS log2_max, round(log2(min(cost)), {D}) AS log2_min,
  round(log2(avg(cost)), {D}) AS log2_mean, arg_min(run, (cost, run)) AS best_run FROM cost""",
    "kmeans_best": LLOYD + f"""SELECT run, j, list_transform(vec, lambda x: round(x, {D})) AS center FROM final
WHERE run = (SELECT arg_min(run, (cost, run)) FROM cost)""",
    "signature_entropy": LLOYD + f""", labs AS (SELECT id, list(j ORDER BY run) AS labels FROM best GROUP BY id),
ex AS (SELECT CAST(k.range AS INTEGER) AS i, labels[1:k.range] AS sig FROM labs CROSS JOIN range(1, {Q.RUNS + 1}) k),
c AS (SELECT i, sig, count(*) AS c FROM ex GROUP BY i, sig),
p AS (SELECT i, c / sum(c) OVER (PARTITION BY i) AS p FROM c)
SELECT i, round(-sum(p * log2(p)), {D}) AS entropy, round(pow(2.0, -sum(p * log2(p))), {D}) AS effective FROM p GROUP BY i""",
    "zip_predictions": f"""SELECT vec_id, {split_sql('vec_id', 'split')} AS split, CAST(label = {Q.COVER_CLASS} AS DOUBLE) AS label,
  CAST(embedding[1] > 0 AS DOUBLE) AS prediction FROM embeddings""",
    "error_rate": RULE + f"SELECT split, round(avg(CAST(label <> prediction AS DOUBLE)), {D}) AS error, count(*) AS n FROM p GROUP BY split",
    "mismatched": RULE + "SELECT split, count(*) AS n_mismatched FROM p WHERE label <> prediction GROUP BY split",
    "linreg_gram": linreg_gram_sql(),
    "sample_fraction": f"SELECT {LINE_KEY} AS key FROM lineitem WHERE {u_sql(LINE_KEY, lit('sample'))} < {Q.SAMPLE_FRACTION!r}",
    "split_70_30": f"SELECT vec_id, {split_sql('vec_id', 'split')} AS split FROM embeddings",
    "split_half": f"SELECT {LINE_KEY} AS key, {split_sql(LINE_KEY, 'half', (0.5, 0.5))} AS split FROM lineitem",
    "mask_split": f"SELECT count(*) AS n, {split_sql(LINE_KEY, 'half', (0.5, 0.5))} AS split FROM lineitem GROUP BY 2",
    "binarize_class": f"SELECT vec_id, CAST(CASE WHEN label = {Q.COVER_CLASS} THEN 1 ELSE 0 END AS DOUBLE) AS label FROM embeddings",
    "binarize_threshold": f"SELECT {LINE_KEY} AS key, CAST(CASE WHEN CAST(l_returnflag = 'R' AS DOUBLE) > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM lineitem",
    "decode_class": f"SELECT vec_id, label, {DECODE} AS name FROM embeddings",
    "class_distribution": f"SELECT label, count(*) AS cnt, round(100.0 * count(*) / sum(count(*)) OVER (), {D}) AS pct FROM embeddings GROUP BY label ORDER BY cnt DESC, label",
    "classes_sorted": f"SELECT label, count(*) AS cnt, round(100.0 * count(*) / sum(count(*)) OVER (), {D}) AS pct FROM embeddings GROUP BY label ORDER BY cnt DESC, label",
    "first_rows": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 2",
    "to_labeled_last": "SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings",
    "to_labeled_first": f"SELECT {LINE_KEY} AS key, CAST(l_returnflag = 'R' AS DOUBLE) AS label, {PARTICLE_FEATURES_SQL} AS features FROM lineitem",
    "split_array_column": "SELECT vec_id, " + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(1, 65)) + " FROM embeddings",
    "slice_columns": f"SELECT {LINE_KEY} AS key, l_quantity, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem",
    "concat_vectors": "WITH " + SERIES.strip() + f""",
wide AS (SELECT station, year,
    max(CASE WHEN measurement = {lit(_C1)} THEN vals END) AS a,
    max(CASE WHEN measurement = {lit(_C2)} THEN vals END) AS b,
    max(CASE WHEN measurement = {lit(_C3)} THEN vals END) AS c FROM series GROUP BY station, year)
SELECT station, year, list_transform(list_concat(list_concat(a, b), c), lambda x: round(x, {D})) AS vec
FROM wide WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL""",
    "derive_measurements": "WITH " + SERIES.strip() + f""",
wide AS (SELECT station, year,
    max(CASE WHEN measurement = {lit(_A)} THEN vals END) AS a,
    max(CASE WHEN measurement = {lit(_B)} THEN vals END) AS b FROM series GROUP BY station, year)
SELECT station, year, [round((a[i] + b[i]) / 2, {D}) for i in range(1, len(a) + 1)] AS avg_values,
       [round(a[i] - b[i], {D}) for i in range(1, len(a) + 1)] AS range_values
FROM wide WHERE a IS NOT NULL AND b IS NOT NULL""",
    "kmeanspp_seed": SEEDS + "SELECT CAST(run AS INTEGER) AS run, j, id AS vec_id FROM seeds",
    "index_to_point": SEEDS + f"SELECT CAST(run AS INTEGER) AS run, j, id AS vec_id, list_transform(vec, lambda x: round(x, {D})) AS center FROM seeds",
    "nearest_center": SEEDS + f"SELECT id AS vec_id, CAST(run AS INTEGER) AS run, j, round(d2, {D}) AS d2 FROM near",
    "center_update": SEEDS + f"""SELECT CAST(run AS INTEGER) AS run, j, n, list(round(m, {D}) ORDER BY dim) AS center FROM (
  SELECT a.run, a.j, count(*) OVER (PARTITION BY a.run, a.j, d.dim) AS n, d.dim, avg(p.vec[d.dim]) OVER (PARTITION BY a.run, a.j, d.dim) AS m,
         row_number() OVER (PARTITION BY a.run, a.j, d.dim) AS rn
  FROM near a JOIN pts p ON a.id = p.id CROSS JOIN range(1, 65) d(dim)) WHERE rn = 1 GROUP BY run, j, n""",
    "potential_sum": SEEDS + f"SELECT CAST(run AS INTEGER) AS run, round(sum(d2), {D}) AS potential FROM near GROUP BY run",
    "seed_signature_entropy": SEEDS + f""", labs AS (SELECT id, list(j ORDER BY run) AS labels FROM near GROUP BY id),
ex AS (SELECT CAST(k.range AS INTEGER) AS i, labels[1:k.range] AS sig FROM labs CROSS JOIN range(1, {Q.RUNS + 1}) k),
c AS (SELECT i, sig, count(*) AS c FROM ex GROUP BY i, sig),
p AS (SELECT i, c / sum(c) OVER (PARTITION BY i) AS p FROM c)
SELECT i, round(-sum(p * log2(p)), {D}) AS entropy, round(pow(2.0, -sum(p * log2(p))), {D}) AS effective FROM p GROUP BY i""",
    "seed_cost_summary": SEEDS + f""", pot AS (SELECT CAST(run AS INTEGER) AS run, sum(d2) AS cost FROM near GROUP BY run)
SELECT round(log2(max(cost)), {D}) AS log2_max, round(log2(min(cost)), {D}) AS log2_min,
       round(log2(avg(cost)), {D}) AS log2_mean, arg_min(run, (cost, run)) AS best_run FROM pot""",
}
