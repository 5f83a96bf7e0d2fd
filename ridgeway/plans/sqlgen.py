"""DuckDB SQL for the correctness oracle of every registered query.

Iterative trainers become recursive CTEs: full-batch GD carries
``(epoch, w0..wd, prev, stopped)`` and aggregates over all rows in the
recursive term; averaged SGD is one recursive fold per epoch, stepping every
shard one row per recursion level, chained epoch after epoch.  The SQL only
checks the Spark jobs; nothing here runs on Spark.
"""

from __future__ import annotations

from collections.abc import Sequence


def num(v: float) -> str:
    """A DOUBLE literal with the exact value of the Python float."""
    v = float(v)
    if v != v:
        return "'nan'::DOUBLE"
    if v in (float("inf"), float("-inf")):
        return f"'{'-' if v < 0 else ''}inf'::DOUBLE"
    return f"{v!r}::DOUBLE"


def rnd(expr: str, digits: int = 6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


# ---- fixtures (mirror ridgeway.sources.tables) --------------------------

LIN_ROWS = ("SELECT l_orderkey, l_linenumber, l_extendedprice / 100000.0::DOUBLE AS y, "
            "l_quantity / 50.0::DOUBLE AS x1, l_discount * 10.0::DOUBLE AS x2, "
            "l_tax * 12.5::DOUBLE AS x3 FROM lineitem")
LOG_ROWS = ("SELECT l_orderkey, l_linenumber, "
            "CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS y, "
            "l_quantity / 50.0::DOUBLE AS x1, l_discount * 10.0::DOUBLE AS x2, "
            "l_tax * 12.5::DOUBLE AS x3 FROM lineitem")
HINGE_ROWS = ("SELECT c_custkey AS id, c_acctbal / 10000.0::DOUBLE AS x1, "
              "c_nationkey / 25.0::DOUBLE AS x2, "
              "CASE WHEN c_mktsegment = 'BUILDING' OR c_acctbal > 4500.0::DOUBLE "
              "THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y FROM customer")
CLASS_ROWS = ("SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features, "
              "CAST(label AS INTEGER) AS label FROM embeddings")
STREAM_ROWS = ("SELECT event_id AS id, value / 500.0::DOUBLE AS x1, "
               "CAST(hour(ts) AS DOUBLE) / 24.0::DOUBLE AS x2, "
               "CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y "
               "FROM events")


def linear_sql(w: Sequence[str], xs: Sequence[str]) -> str:
    """w0 + w1*x1 + ... accumulated from the intercept (left-associative)."""
    z = f"{w[0]}"
    for wi, xi in zip(w[1:], xs):
        z = f"{z} + {wi} * {xi}"
    return z


def dot_then_bias_sql(w: Sequence[str], xs: Sequence[str], b: str) -> str:
    z = " + ".join(f"{xi} * {wi}" for wi, xi in zip(w, xs))
    return f"({z}) + {b}"


def nll_sql(z: str, y: str) -> str:
    return f"(greatest({z}, 0.0::DOUBLE) + ln(1.0::DOUBLE + exp(-abs({z}))) - {y} * {z})"


def model_rows_sql(source: str, weight_cols: Sequence[str], digits: int = 6,
                   class_idx: int = 0) -> str:
    """Unpivot one-row ``source`` with columns w0..wd to the model table."""
    parts = [f"SELECT {class_idx}::INTEGER AS class_idx, {i}::INTEGER AS feature_idx, "
             f"{rnd(c, digits)} AS weight FROM {source}" for i, c in enumerate(weight_cols)]
    return " UNION ALL ".join(parts)


# ---- full-batch gradient descent ----------------------------------------

def gd_cte(rows_sql: str, d: int, loss: str, lr: float, l2: float, tol: float,
           max_epochs: int, init: Sequence[str]) -> str:
    """``WITH RECURSIVE rows AS (...), gd AS (...)``; state row e holds the
    weights after epoch e (unchanged on the stopping epoch)."""
    ws = [f"w{i}" for i in range(d + 1)]
    xs = [f"x{i}" for i in range(1, d + 1)]
    state_cols = ", ".join(ws)
    z = linear_sql([f"s.{w}" for w in ws], [f"r.{x}" for x in xs])
    if loss == "squared":
        terms = f"(z - y) AS diff, (z - y) * (z - y) AS lt"
    else:
        terms = (f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) - y) AS diff, "
                 f"{nll_sql('z', 'y')} AS lt")
    grads = ", ".join(["sum(diff) AS g0"] + [f"sum(diff * {x}) AS g{i}" for i, x in enumerate(xs, 1)])
    pen = "0.0::DOUBLE"
    if loss == "squared" and l2:
        pen = f"{num(l2)} * ({' + '.join(f'{w} * {w}' for w in ws[1:])})"
    if loss == "squared":
        new = [f"w0 - 2.0::DOUBLE * {num(lr)} * g0 / n"] + [
            f"w{i} - (2.0::DOUBLE * {num(lr)} * g{i} / n + 2.0::DOUBLE * {num(l2)} * w{i})"
            for i in range(1, d + 1)]
    else:
        new = [f"w{i} - {num(lr)} * g{i} / n" for i in range(d + 1)]
    new_sel = ", ".join(f"CASE WHEN go THEN {e} ELSE w{i} END" for i, e in enumerate(new))
    delta = " + ".join(f"({e} - w{i}) * ({e} - w{i})" for i, e in enumerate(new))
    init_sel = ", ".join(f"{v}" for v in init)
    return f"""WITH RECURSIVE
rows AS ({rows_sql}),
gd(epoch, {state_cols}, prev, n_rows, loss, delta, stopped) AS (
  SELECT 0, {init_sel}, 'inf'::DOUBLE, 0::BIGINT, NULL::DOUBLE, NULL::DOUBLE, false
  UNION ALL
  SELECT epoch + 1, {new_sel},
         CASE WHEN go THEN loss ELSE prev END, n, loss,
         CASE WHEN go THEN sqrt({delta}) ELSE 0.0::DOUBLE END, NOT go
  FROM (
    SELECT *, (prev - loss > {num(tol)}) AS go
    FROM (
      SELECT *, ls / n + {pen} AS loss
      FROM (
        SELECT epoch, {state_cols}, prev, count(*) AS n, sum(lt) AS ls, {grads}
        FROM (
          SELECT epoch, {state_cols}, prev, {", ".join(xs)}, {terms}
          FROM (
            SELECT s.epoch, {", ".join(f"s.{w}" for w in ws)}, s.prev, r.y,
                   {", ".join(f"r.{x}" for x in xs)}, {z} AS z
            FROM gd s, rows r
            WHERE NOT s.stopped AND s.epoch < {int(max_epochs)}
          ) a
        ) b
        GROUP BY epoch, {state_cols}, prev
      ) c
    ) e
  ) f
)"""


def gd_gram_cte(rows_sql: str, d: int, lr: float, l2: float, tol: float, init: Sequence[str]) -> str:
    """Squared-loss GD to its stop test, without an epoch limit: one pass of Gram statistics, then one recursion
    step an epoch over (d+1)^2 numbers.  Same shape as :func:`gd_cte` at the end: ``gd(epoch, w0..wd, ...)``."""
    xs = ["1.0::DOUBLE"] + [f"x{i}" for i in range(1, d + 1)]
    G = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in xs) + "]" for a in xs)
    h = ", ".join(f"sum({a} * y)" for a in xs)
    two_lr, two_l2 = num(2.0 * lr), num(2.0 * l2)
    decay = f" - CASE WHEN i = 1 THEN 0.0::DOUBLE ELSE {two_l2} * v END" if l2 else ""
    pen = f" + {num(l2)} * list_dot_product(w[2:], w[2:])" if l2 else ""
    return f"""WITH RECURSIVE
rows AS ({rows_sql}),
stats AS MATERIALIZED (SELECT count(*) AS n, sum(y * y) AS q, [{h}] AS h, [{G}] AS gram FROM rows),
steps AS (
  SELECT 0 AS epoch, [{', '.join(init)}] AS w, 'inf'::DOUBLE AS prev, NULL::DOUBLE AS loss, false AS stopped
  UNION ALL
  SELECT epoch + 1, CASE WHEN go THEN list_transform(w, lambda v, i: v - {two_lr} * (gw[i] - h[i]) / n{decay}) ELSE w END,
         CASE WHEN go THEN loss ELSE prev END, loss, NOT go
  FROM (SELECT *, prev - loss > {num(tol)} AS go FROM (
    SELECT *, (list_dot_product(w, gw) - 2.0::DOUBLE * list_dot_product(w, h) + q) / n{pen} AS loss FROM (
      SELECT s.epoch, s.w, s.prev, t.n, t.q, t.h, list_transform(t.gram, lambda g: list_dot_product(g, s.w)) AS gw
      FROM steps s, stats t WHERE NOT s.stopped) a) b) c
),
gd AS (SELECT epoch, {', '.join(f'w[{i + 1}] AS w{i}' for i in range(d + 1))}, loss, stopped FROM steps)"""


def gd_model_sql(cte: str, d: int, digits: int = 6) -> str:
    ws = [f"w{i}" for i in range(d + 1)]
    return (f"{cte},\nlast AS (SELECT * FROM gd WHERE epoch = (SELECT max(epoch) FROM gd))\n"
            + model_rows_sql("last", ws, digits))


def gd_history_sql(cte: str, digits: int = 6) -> str:
    return (f"{cte}\nSELECT CAST(epoch AS INTEGER) AS epoch, n_rows, {rnd('loss', digits)} AS loss, "
            f"{rnd('delta', digits)} AS param_delta, stopped FROM gd WHERE epoch >= 1")


# ---- parameter-averaged SGD ----------------------------------------------
#
# Per epoch e:  ord_e   rows numbered 1..n_s inside each shard in epoch order
#               fold_e  recursive: every shard advances one row per level
#               end_e   last state of each shard (the start row for an empty shard)
#               model_e unweighted mean over exactly S shards, + delta and stop flag
# All epochs are generated; the answer is the first epoch that stopped, else the last.

ORDER_ROOT, ORDER_MOD = 48271, 2147483647


def pmod_sql(expr: str, m: int | str) -> str:
    return f"((({expr}) % {m} + {m}) % {m})"


SHARD_MULT, SHARD_ADD, SHARD_MOD = 1327217885, 3, 2147483647


def shard_sql(id_expr: str, shards: int | str) -> str:
    inner = pmod_sql(f"{pmod_sql(id_expr, SHARD_MOD)} * {SHARD_MULT} + {SHARD_ADD}", SHARD_MOD)
    return pmod_sql(inner, shards)


def order_sql(epoch: int, order: str) -> str:
    if order == "id":
        return "id"
    return f"{pmod_sql(f'{pmod_sql("id", ORDER_MOD)} * {pow(ORDER_ROOT, epoch, ORDER_MOD)}', ORDER_MOD)}, id"


class _Hinge:
    """Binary hinge state: scalar columns w1..wd, b."""

    def __init__(self, d: int, alpha: float, l2: float, fit_intercept: bool) -> None:
        self.d, self.a, self.l, self.fi = d, num(alpha), num(l2), fit_intercept
        self.ws = [f"w{j}" for j in range(1, d + 1)]
        self.xs = [f"x{j}" for j in range(1, d + 1)]
        self.state = self.ws + ["b"]

    def row_cols(self) -> list[str]:
        return self.xs + ["y"]

    def pre(self) -> str:
        return f"{dot_then_bias_sql([f'f.{w}' for w in self.ws], [f'r.{x}' for x in self.xs], 'f.b')} AS z"

    def updates(self) -> list[str]:
        a, l = self.a, self.l
        out = [f"CASE WHEN y * z < 1.0::DOUBLE THEN {w} - {a} * ({w} * {l} - y * {x}) "
               f"ELSE {w} - {a} * ({w} * {l}) END" for w, x in zip(self.ws, self.xs)]
        out.append(f"CASE WHEN y * z < 1.0::DOUBLE THEN b - {a} * (-y) ELSE b END" if self.fi else "b")
        return out

    def loss(self) -> str:
        return "CASE WHEN y * z < 1.0::DOUBLE THEN 1.0::DOUBLE - y * z ELSE 0.0::DOUBLE END"

    def average(self, src: str) -> str:
        return ", ".join(f"avg({c}) AS {c}" for c in self.state) + f" FROM {src}"

    def delta(self, new: str, old: str) -> str:
        return "sqrt(" + " + ".join(f"({new}.{c} - {old}.{c}) * ({new}.{c} - {old}.{c})"
                                    for c in self.state) + ")"

    def model_rows(self, src: str, digits: int) -> str:
        return model_rows_sql(src, ["b"] + self.ws, digits)


class _Multi:
    """K-class state: W DOUBLE[] (K*d, row-major), b DOUBLE[] (K)."""

    def __init__(self, kind: str, K: int, d: int, alpha: float, l2: float, fit_intercept: bool) -> None:
        self.kind, self.K, self.d = kind, K, d
        self.a, self.l, self.fi = num(alpha), num(l2), fit_intercept
        self.state = ["W", "b"]

    def row_cols(self) -> list[str]:
        return ["features", "label"]

    def pre(self) -> str:
        K, d = self.K, self.d
        return (f"list_transform(range(0, {K}), lambda k: list_dot_product("
                f"list_slice(f.W, k * {d} + 1, k * {d} + {d}), r.features) + f.b[k + 1]) AS s")

    def pre2(self) -> str:
        if self.kind == "multiclass_hinge":
            return ("list_transform(s, lambda v, k: CASE WHEN k = label + 1 THEN 0.0::DOUBLE "
                    "ELSE v - s[label + 1] + 1.0::DOUBLE END) AS m")
        return "list_max(s) AS mx"

    def pre3(self) -> str:
        if self.kind == "multiclass_hinge":
            return ("list_transform(m, lambda v, k: CASE WHEN k = label + 1 THEN "
                    "-CAST(len(list_filter(m, lambda u: u > 0.0::DOUBLE)) AS DOUBLE) "
                    "ELSE CAST(v > 0.0::DOUBLE AS DOUBLE) END) AS c")
        return "list_transform(s, lambda v: exp(v - mx)) AS e"

    def pre4(self) -> str:
        if self.kind == "multiclass_hinge":
            return "NULL AS unused"
        return ("list_transform(list_transform(e, lambda v: v / list_sum(e)), lambda p, k: "
                "CASE WHEN k = label + 1 THEN 1.0::DOUBLE - p ELSE -p END) AS g")

    def updates(self) -> list[str]:
        a, l, d = self.a, self.l, self.d
        if self.kind == "multiclass_hinge":
            W = (f"list_transform(W, lambda w, i: w - {a} * (c[(i - 1) // {d} + 1] * "
                 f"features[(i - 1) % {d} + 1] + {l} * w))")
            b = f"list_transform(b, lambda v, k: v - {a} * c[k])" if self.fi else "b"
        else:
            W = (f"list_transform(W, lambda w, i: w + {a} * (g[(i - 1) // {d} + 1] * "
                 f"features[(i - 1) % {d} + 1] - {l} * w))")
            b = f"list_transform(b, lambda v, k: v + {a} * g[k])" if self.fi else "b"
        return [W, b]

    def loss(self) -> str:
        if self.kind == "multiclass_hinge":
            return "coalesce(list_sum(list_filter(m, lambda v: v > 0.0::DOUBLE)), 0.0::DOUBLE)"
        return "(-(s[label + 1] - mx) + ln(list_sum(e)))"

    def average(self, src: str) -> str:
        K, d = self.K, self.d
        return (f"(SELECT list(v ORDER BY i) FROM (SELECT i, avg(v) AS v FROM "
                f"(SELECT unnest(W) AS v, unnest(range(1, {K * d + 1})) AS i FROM {src}) u GROUP BY i) t) AS W, "
                f"(SELECT list(v ORDER BY i) FROM (SELECT i, avg(v) AS v FROM "
                f"(SELECT unnest(b) AS v, unnest(range(1, {K + 1})) AS i FROM {src}) u GROUP BY i) t) AS b "
                f"FROM (SELECT 1) one")

    def delta(self, new: str, old: str) -> str:
        return (f"sqrt(list_sum(list_transform(list_zip({new}.W, {old}.W), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
                f" + list_sum(list_transform(list_zip({new}.b, {old}.b), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))")

    def model_rows(self, src: str, digits: int) -> str:
        d = self.d
        return (f"SELECT CAST((i - 1) // {d} AS INTEGER) AS class_idx, CAST((i - 1) % {d} + 1 AS INTEGER) "
                f"AS feature_idx, {rnd('v', digits)} AS weight FROM "
                f"(SELECT unnest(W) AS v, unnest(range(1, {self.K * d + 1})) AS i FROM {src}) u "
                f"UNION ALL SELECT CAST(i - 1 AS INTEGER) AS class_idx, 0::INTEGER AS feature_idx, "
                f"{rnd('v', digits)} AS weight FROM "
                f"(SELECT unnest(b) AS v, unnest(range(1, {self.K + 1})) AS i FROM {src}) u")


def sgd_state(kind: str, K: int, d: int, alpha: float, l2: float, fit_intercept: bool = True):
    if kind == "hinge":
        return _Hinge(d, alpha, l2, fit_intercept)
    return _Multi(kind, K, d, alpha, l2, fit_intercept)


def hinge_init(coef: Sequence[float], intercept: float) -> str:
    cols = [f"{num(w)} AS w{j}" for j, w in enumerate(coef, 1)] + [f"{num(intercept)} AS b"]
    return "SELECT " + ", ".join(cols)


def multi_init(coef_flat: Sequence[float] | None, intercept: Sequence[float] | None, K: int, d: int) -> str:
    if coef_flat is None:
        W = f"list_transform(range(0, {K * d}), lambda i: 0.0::DOUBLE)"
    else:
        W = "[" + ", ".join(num(v) for v in coef_flat) + "]"
    if intercept is None:
        b = f"list_transform(range(0, {K}), lambda i: 0.0::DOUBLE)"
    else:
        b = "[" + ", ".join(num(v) for v in intercept) + "]"
    return f"SELECT {W} AS W, {b} AS b"


def shards_sql(cfg, rows_sql: str) -> int | str:
    """The shard count as configured: a number, or computed from ``count(*)``."""
    if cfg.rows_per_shard is None:
        return cfg.shards
    return f"(SELECT greatest(1, CAST(ceil(count(*) / {cfg.rows_per_shard}.0) AS BIGINT)) FROM ({rows_sql}) counted)"


def sgd_chain_sql(rows_sql: str, st, shards: int | str, epochs: int, tol: float, order: str,
                  init_sql: str, chunk_expr: str | None = None) -> str:
    """CTE text ending in ``models(epoch, <state>, n_rows, loss_sum, delta, stopped)``
    plus ``final`` (the adopted model) -- without a trailing SELECT.

    ``chunk_expr`` (an expression over ``id``) restricts epoch e to the rows of
    chunk e-1: the micro-batches of a stream instead of full passes."""
    state = ", ".join(st.state)
    rc = st.row_cols()
    chunk = f", {chunk_expr} AS chunk" if chunk_expr else ""
    parts = [f"rows AS (SELECT {', '.join(rc)}, CAST({shard_sql('id', shards)} AS INTEGER) AS shard, id{chunk} "
             f"FROM ({rows_sql}) src)",
             f"model_0 AS (SELECT 0 AS epoch, {state}, 0::BIGINT AS n_rows, 0.0::DOUBLE AS loss_sum, "
             f"NULL::DOUBLE AS delta, false AS stopped FROM ({init_sql}) i)"]
    for e in range(1, epochs + 1):
        parts.append(
            f"ord_{e} AS (SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY {order_sql(e, order)}) AS rn, "
            f"{', '.join(rc)} FROM rows{f' WHERE chunk = {e - 1}' if chunk_expr else ''})")
        if isinstance(st, _Hinge):
            inner = (f"SELECT f.shard, r.rn, {', '.join('f.' + c for c in st.state)}, f.n, f.loss, "
                     f"{', '.join('r.' + c for c in rc)}, {st.pre()} "
                     f"FROM fold_{e} f JOIN ord_{e} r ON r.shard = f.shard AND r.rn = f.rn + 1")
        else:
            inner = (f"SELECT *, {st.pre4()} FROM (SELECT *, {st.pre3()} FROM (SELECT *, {st.pre2()} FROM ("
                     f"SELECT f.shard, r.rn, f.W, f.b, f.n, f.loss, r.features, r.label, {st.pre()} "
                     f"FROM fold_{e} f JOIN ord_{e} r ON r.shard = f.shard AND r.rn = f.rn + 1) q1) q2) q3")
        upd = ", ".join(st.updates())
        parts.append(
            f"fold_{e}(shard, rn, {state}, n, loss) AS ("
            f"SELECT CAST(sh.range AS INTEGER), 0::BIGINT, {', '.join('m.' + c for c in st.state)}, 0::BIGINT, "
            f"0.0::DOUBLE FROM range({shards}) sh, model_{e - 1} m "
            f"UNION ALL SELECT shard, rn, {upd}, n + 1, loss + {st.loss()} FROM ({inner}) q)")
        parts.append(
            f"end_{e} AS (SELECT f.* FROM fold_{e} f JOIN (SELECT shard, max(rn) AS mrn FROM fold_{e} "
            f"GROUP BY shard) mx ON f.shard = mx.shard AND f.rn = mx.mrn)")
        parts.append(
            f"avg_{e} AS (SELECT {st.average(f'end_{e}')})")
        parts.append(
            f"model_{e} AS (SELECT {e} AS epoch, {', '.join('a.' + c for c in st.state)}, "
            f"(SELECT sum(n) FROM end_{e})::BIGINT AS n_rows, (SELECT sum(loss) FROM end_{e}) AS loss_sum, "
            f"{st.delta('a', 'p')} AS delta, {st.delta('a', 'p')} < {num(tol)} AS stopped "
            f"FROM avg_{e} a, model_{e - 1} p)")
    union = " UNION ALL ".join(f"SELECT * FROM model_{e}" for e in range(1, epochs + 1))
    parts.append(f"models AS ({union})")
    parts.append("last_epoch AS (SELECT coalesce(min(epoch) FILTER (WHERE stopped), max(epoch)) AS e FROM models)")
    parts.append("final AS (SELECT m.* FROM models m, last_epoch l WHERE m.epoch = l.e)")
    return "WITH RECURSIVE " + ",\n".join(parts)


def sgd_model_sql(rows_sql: str, st, shards: int | str, epochs: int, tol: float, order: str,
                  init_sql: str, digits: int = 6) -> str:
    return sgd_chain_sql(rows_sql, st, shards, epochs, tol, order, init_sql) + "\n" + st.model_rows("final", digits)


def sgd_history_sql(rows_sql: str, st, shards: int | str, epochs: int, tol: float, order: str,
                    init_sql: str, digits: int = 6) -> str:
    return (sgd_chain_sql(rows_sql, st, shards, epochs, tol, order, init_sql)
            + f"\nSELECT CAST(epoch AS INTEGER) AS epoch, n_rows, "
              f"{rnd('CASE WHEN n_rows > 0 THEN loss_sum / n_rows END', digits)} AS loss, "
              f"{rnd('delta', digits)} AS param_delta, stopped FROM models, last_epoch l WHERE epoch <= l.e")


# ---- averaged SGD of any length -------------------------------------------
#
# One recursion step is one epoch: its rows are gathered into one ordered list a shard and folded by
# list_reduce from the epoch's model.  A model has a list [b, w1..wd] a class.  Rows are [[label], [1, x1..xd]] and
# accumulators [[loss], class lists...]; the hinge's are flat, [y, x1..xd] and [loss, b, w1..wd].

SHARD_ROOT = 69621


def _sgd_fold(kind: str, d: int, alpha: float, l2: float) -> str:
    """The fold of an ordered list ``rr`` from model ``m``, as [[loss], class lists...]."""
    a, l = num(alpha), num(l2)
    if kind == "hinge":
        z = " + ".join(f"r[{j + 1}] * a[{j + 2}]" for j in range(1, d + 1))
        cells = ["a[1] + greatest(1.0::DOUBLE - p, 0.0::DOUBLE)", f"a[2] - {a} * CASE WHEN p < 1.0::DOUBLE THEN -r[1] ELSE 0.0::DOUBLE END"]
        cells += [f"a[{j + 2}] - {a} * (a[{j + 2}] * {l} - CASE WHEN p < 1.0::DOUBLE THEN r[1] * r[{j + 1}] ELSE 0.0::DOUBLE END)" for j in range(1, d + 1)]
        step = f"list_transform([r[1] * (({z}) + a[2])], lambda p: [{', '.join(cells)}])[1]"
        return f"list_transform([list_reduce(rr, lambda a, r: {step}, list_concat([0.0::DOUBLE], m[1]))], lambda f: [[f[1]], f[2:]])[1]"
    y = "r[1][1]"
    decay = f" + CASE WHEN i = 1 THEN 0.0::DOUBLE ELSE {l} * w END" if l2 else ""

    def move(pull: str) -> str:
        """Each class list minus alpha (its coefficient x + l2 w, the intercept without decay)."""
        return (f"list_transform(list_zip(a[2:], {pull}), lambda q: "
                f"list_transform(q[1], lambda w, i: w - {a} * (q[2] * r[2][i]{decay})))")

    scores = "list_transform(a[2:], lambda w: list_dot_product(w, r[2]))"
    if kind == "softmax":
        pull = f"list_transform(e, lambda v, k: v / list_sum(e) - CAST(k = {y} + 1 AS INTEGER))"
        step = (f"list_transform([list_transform({scores}, lambda v: exp(v))], lambda e: list_concat("
                f"[[a[1][1] + ln(list_sum(e)) - ln(e[CAST({y} AS INTEGER) + 1])]], {move(pull)}))[1]")
    else:
        margins = f"list_transform(s, lambda v, k: CASE WHEN k = {y} + 1 THEN 0.0::DOUBLE ELSE v - s[CAST({y} AS INTEGER) + 1] + 1.0::DOUBLE END)"
        over = "list_filter(m, lambda v: v > 0.0::DOUBLE)"
        pull = (f"list_transform(m, lambda v, k: CASE WHEN k = {y} + 1 THEN -CAST(len({over}) AS DOUBLE) "
                f"ELSE CAST(CAST(v > 0.0::DOUBLE AS INTEGER) AS DOUBLE) END)")
        step = (f"list_transform([list_transform([{scores}], lambda s: {margins})[1]], lambda m: list_concat("
                f"[[a[1][1] + coalesce(list_sum({over}), 0.0::DOUBLE)]], {move(pull)}))[1]")
    return f"list_reduce(rr, lambda a, r: {step}, list_concat([[0.0::DOUBLE]], m))"


def sgd_run_cte(rows_sql: str, kind: str, K: int, d: int, alpha: float, l2: float, shards: int | str,
                epochs: int, tol: float, order: str = "hash", reshard: bool = False) -> str:
    """``WITH RECURSIVE ... run(epoch, ..., m, n_rows, loss, delta, stopped)`` from a zero model."""
    M = ORDER_MOD
    row = (f"[y, {', '.join(f'x{j}' for j in range(1, d + 1))}]" if kind == "hinge"
           else "[[CAST(label AS DOUBLE)], list_concat([1.0::DOUBLE], features)]")
    shard = pmod_sql(f"({pmod_sql('id', SHARD_MOD)} * fs + {SHARD_ADD}) % {SHARD_MOD}", "s")
    ordered = "id" if order == "id" else f"{pmod_sql('id', M)} * fo % {M}, id"
    first_shard = SHARD_MULT * SHARD_ROOT % M if reshard else SHARD_MULT
    next_shard = f"fs * {SHARD_ROOT} % {M}" if reshard else "fs"
    return f"""WITH RECURSIVE
rows AS MATERIALIZED (SELECT id, {row} AS r FROM ({rows_sql}) src),
run AS (
  SELECT 0 AS epoch, {ORDER_ROOT}::BIGINT AS fo, {first_shard}::BIGINT AS fs, CAST({shards} AS BIGINT) AS s,
    list_transform(range(0, {K}), lambda k: list_transform(range(0, {d + 1}), lambda j: 0.0::DOUBLE)) AS m,
    0::BIGINT AS n_rows, 0.0::DOUBLE AS loss, NULL::DOUBLE AS delta, false AS stopped
  UNION ALL
  SELECT epoch + 1, fo * {ORDER_ROOT} % {M}, {next_shard}, s, new, n, loss, delta, delta < {num(tol)} FROM (
    SELECT *, sqrt(list_sum(list_transform(list_zip(flatten(new), flatten(old)), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS delta FROM (
      SELECT epoch, fo, fs, s, n, loss, old, list_transform(list_zip(total, old), lambda q: list_transform(list_zip(q[1], q[2]),
               lambda p: (p[1] + (s - dealt_to) * p[2]) / s)) AS new FROM (
        SELECT any_value(epoch) AS epoch, any_value(fo) AS fo, any_value(fs) AS fs, any_value(s) AS s, CAST(sum(n) AS BIGINT) AS n,
          sum(f[1][1]) AS loss, any_value(m) AS old, count(*) AS dealt_to,
          list_reduce(list(f[2:] ORDER BY shard), lambda a, b: list_transform(list_zip(a, b), lambda q: list_transform(list_zip(q[1], q[2]),
            lambda p: p[1] + p[2]))) AS total FROM (
          SELECT *, {_sgd_fold(kind, d, alpha, l2)} AS f FROM (
            SELECT shard, any_value(epoch) AS epoch, any_value(fo) AS fo, any_value(fs) AS fs, any_value(s) AS s, any_value(m) AS m,
              count(*) AS n, list(r ORDER BY {ordered.replace('fo', 'by_fo')}) AS rr
            FROM (SELECT rows.id, rows.r, run.*, run.fo AS by_fo, {shard} AS shard FROM rows, run WHERE NOT stopped AND epoch < {int(epochs)}) dealt
            GROUP BY shard) ordered
        ) folded
      ) summed WHERE epoch IS NOT NULL
    ) averaged
  ) moved
),
final AS (SELECT * FROM run WHERE epoch = (SELECT max(epoch) FROM run))"""


def sgd_run_model_sql(cte: str, digits: int = 6) -> str:
    return (f"{cte}\nSELECT CAST(k - 1 AS INTEGER) AS class_idx, CAST(j - 1 AS INTEGER) AS feature_idx, {rnd('v', digits)} AS weight FROM "
            f"(SELECT k, unnest(c) AS v, unnest(range(1, len(c) + 1)) AS j FROM "
            f"(SELECT unnest(m) AS c, unnest(range(1, len(m) + 1)) AS k FROM final) classes) cells")


def sgd_run_history_sql(cte: str, digits: int = 6) -> str:
    return (f"{cte}\nSELECT CAST(epoch AS INTEGER) AS epoch, n_rows, {rnd('loss / n_rows', digits)} AS loss, "
            f"{rnd('delta', digits)} AS param_delta, stopped FROM run WHERE epoch >= 1")
