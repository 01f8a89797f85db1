"""Independent SQL for every registered query, runnable by DuckDB.

The SQL restates each query's meaning from scratch (no Spark plan is
translated); iterative fits are unrolled into one materialized CTE per round,
generated from the same parameters the Spark side uses.
"""

from __future__ import annotations

from ..sources import extract as X

# The extraction's values, stated here again.
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
VECTOR_WIDTH = 64


def _fx(expr: str, digits: int) -> str:
    """``expr`` rounded to ``digits`` decimals as round(x * 10^d) / 10^d."""
    f = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(round(({expr}) * {f}) / {f})"


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# --------------------------------------------------------------- extraction

Q20_FEATURES = f"""
WITH per_order AS (
  SELECT l_orderkey,
         count_if(l_returnflag = 'R') AS ret_lines,
         sum(l_quantity) AS qty,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS ret_qty,
         sum(CAST(round(l_extendedprice * 100.0) AS BIGINT)) AS amt,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100.0) AS BIGINT) ELSE 0 END) AS ret_amt
  FROM lineitem GROUP BY l_orderkey),
per_customer AS (
  SELECT o_custkey AS c_custkey, count(*) AS n_orders, count_if(ret_lines > 0) AS n_ret_orders,
         sum(qty) AS qty, sum(ret_qty) AS ret_qty, sum(amt) AS amt, sum(ret_amt) AS ret_amt,
         sum(ret_lines) AS ret_lines
  FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
       {_fx("CAST(n_ret_orders AS DOUBLE) / n_orders", 6)} AS order_ratio,
       {_fx("ret_qty / qty", 6)} AS item_ratio,
       {_fx("CAST(ret_amt AS DOUBLE) / CAST(amt AS DOUBLE)", 6)} AS amount_ratio,
       CAST(ret_lines AS DOUBLE) AS returns
FROM per_customer
"""

Q25_FEATURES = f"""
SELECT CAST(o_custkey AS BIGINT) AS c_custkey,
       CAST(date_diff('day', CAST(max(o_orderdate) AS DATE),
                      CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS DOUBLE) AS recency,
       CAST(count(*) AS DOUBLE) AS frequency,
       {_fx("CAST(sum(CAST(round(o_totalprice * 100.0) AS BIGINT)) AS DOUBLE) / 100000.0", 3)} AS monetary
FROM orders GROUP BY o_custkey
"""


def q26_features_sql(types=PART_TYPES) -> str:
    counts = ",\n         ".join(f"count_if(p_type = '{t}') AS n_{t.lower()}" for t in types)
    sums = ",\n       ".join(f"CAST(sum(n_{t.lower()}) AS DOUBLE) AS n_{t.lower()}" for t in types)
    return f"""
WITH per_order AS (
  SELECT l_orderkey,
         {counts},
         count(*) AS n_lines
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey)
SELECT CAST(o_custkey AS BIGINT) AS c_custkey,
       {sums},
       CAST(sum(n_lines) AS DOUBLE) - {" - ".join(f"CAST(sum(n_{t.lower()}) AS DOUBLE)" for t in types)} AS n_other
FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey
"""


Q05_FEATURES = f"""
WITH per_order AS (
  SELECT l_orderkey, count(*) AS lines, count_if(p_type = '{X.Q05_CATEGORY}') AS cat_lines
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
per_customer AS (
  SELECT o_custkey, sum(lines) AS lines, sum(cat_lines) AS cat_lines
  FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey),
totals AS (SELECT sum(lines) AS all_lines, sum(cat_lines) AS all_cat FROM per_customer)
SELECT CAST(c_custkey AS BIGINT) AS c_customer_sk,
       CAST(c_acctbal > {X.Q05_BALANCE_LIMIT} AS DOUBLE) AS flag_balance,
       CAST(c_mktsegment IN ({_in_list(X.Q05_SEGMENTS)}) AS DOUBLE) AS flag_segment,
       CAST(cat_lines::HUGEINT * all_lines > all_cat::HUGEINT * lines AS DOUBLE) AS label
FROM per_customer JOIN customer ON o_custkey = c_custkey CROSS JOIN totals
"""

def embedding_features_sql(dims: int = VECTOR_WIDTH) -> str:
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(dims))
    return f"SELECT CAST(vec_id AS BIGINT) AS vec_id, {xs} FROM embeddings"


def parse_space_embeddings_sql(dims: int = VECTOR_WIDTH) -> str:
    xs = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(dims))
    return f"SELECT {xs} FROM embeddings"


Q28_DOCUMENTS = f"""
SELECT CAST(d.doc_id AS BIGINT) AS doc_id,
       CASE WHEN l.toxic = 1 THEN 'NEG' WHEN l.quality = 1 THEN 'POS' ELSE 'NEU' END AS label,
       d.text AS text,
       CASE WHEN d.doc_id % 10 < {X.Q28_TRAIN_BUCKETS} THEN 'train' ELSE 'test' END AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


# ------------------------------------------------------------------ k-means

def _dist(p: str, c: str, cols) -> str:
    return " + ".join(f"({p}.{f} - {c}.{f}) * ({p}.{f} - {c}.{f})" for f in cols)


def kmeans_ctes(features_sql: str, id_col: str, cols, k: int = 8, rounds: int = 10,
                scale: int | None = 6, salt: str = "") -> str:
    """CTEs ``pts``, ``c0`` .. ``c{rounds}`` and ``fin`` (final assignment).
    Centre means use exact integer sums of the features at ``scale`` decimals, or plain averages."""
    cols = list(cols)
    factor = f"CAST({10 ** (scale or 0)} AS DOUBLE)"
    start = f"md5(CAST({id_col} AS VARCHAR) || '{salt}')"
    fl = ", ".join(cols)
    parts = [f"pts AS MATERIALIZED ({features_sql})",
             f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY {start}) - 1 AS INTEGER) AS cluster_id, {fl}
  FROM pts ORDER BY {start} LIMIT {k})"""]

    def assign(prev: str, name: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT p.{id_col}, {", ".join("p." + f for f in cols)},
         min({{'d': {_dist("p", "c", cols)}, 'c': c.cluster_id}}) AS best
  FROM pts p CROSS JOIN {prev} c
  GROUP BY p.{id_col}, {", ".join("p." + f for f in cols)})"""

    for r in range(1, rounds + 1):
        parts.append(assign(f"c{r - 1}", f"a{r}"))
        avgs = ", ".join(
            (f"coalesce(avg(a.{f}), c.{f}) AS {f}" if scale is None else
             f"coalesce(CAST(sum(CAST(round(a.{f} * {factor}) AS BIGINT)) AS DOUBLE) / count(a.{f}) / {factor}, "
             f"c.{f}) AS {f}") for f in cols)
        parts.append(f"""c{r} AS MATERIALIZED (
  SELECT c.cluster_id, {avgs}
  FROM c{r - 1} c LEFT JOIN a{r} a ON a.best.c = c.cluster_id
  GROUP BY c.cluster_id, {", ".join("c." + f for f in cols)})""")
    parts.append(assign(f"c{rounds}", "fin"))
    return "WITH " + ",\n".join(parts)


def kmeans_sql(kind: str, features_sql: str, id_col: str, cols, k: int = 8,
               rounds: int = 10, scale: int | None = 6, salt: str = "") -> str:
    ctes = kmeans_ctes(features_sql, id_col, cols, k, rounds, scale, salt)
    last = f"c{rounds}"
    if kind == "assign":
        body = f"SELECT CAST({id_col} AS BIGINT) AS {id_col}, CAST(best.c AS INTEGER) AS cluster_id FROM fin"
    elif kind == "sizes":
        body = (f"SELECT CAST(c.cluster_id AS INTEGER) AS cluster_id, CAST(count(f.best) AS BIGINT) AS n "
                f"FROM {last} c LEFT JOIN fin f ON f.best.c = c.cluster_id GROUP BY c.cluster_id")
    elif kind == "cost":
        body = ("SELECT CASE WHEN c = 0 THEN 0.0::DOUBLE ELSE round(c * pow(10.0::DOUBLE, 9 - floor(log10(c)))) "
                "/ pow(10.0::DOUBLE, 9 - floor(log10(c))) END AS cost FROM (SELECT sum(best.d) AS c FROM fin)")
    elif kind == "centers":
        body = f"SELECT CAST(cluster_id AS INTEGER) AS cluster_id, {', '.join(cols)} FROM {last}"
    elif kind == "report":
        plain = ", ".join(f"c.{f}" for f in cols)
        body = (f"SELECT CAST(c.cluster_id AS INTEGER) AS cluster_id, {plain}, "
                f"CAST(count(f.best) AS BIGINT) AS n "
                f"FROM {last} c LEFT JOIN fin f ON f.best.c = c.cluster_id "
                f"GROUP BY c.cluster_id, {', '.join('c.' + f for f in cols)}")
    else:
        raise ValueError(kind)
    return ctes + "\n" + body


def kmeans_run_costs_sql(features_sql: str, id_col: str, cols, runs: int, **more) -> str:
    """Run and cost (10 significant digits) of the runs from starts salted with ':1', ':2', ..."""
    return " UNION ALL ".join(f"SELECT {r}::INT AS run, cost FROM ({kmeans_sql('cost', features_sql, id_col, cols, salt=f':{r + 1}', **more)})" for r in range(runs))


def kmeans_best_of_sql(features_sql: str, id_col: str, cols, runs: int, **more) -> str:
    """The report of the run with the least cost, the first of equal ones."""
    reports = " UNION ALL ".join(f"SELECT {r} AS run, * FROM ({kmeans_sql('report', features_sql, id_col, cols, salt=f':{r + 1}', **more)})" for r in range(runs))
    costs = kmeans_run_costs_sql(features_sql, id_col, cols, runs, **more)
    return f"SELECT * EXCLUDE (run) FROM ({reports}) WHERE run = (SELECT run FROM ({costs}) ORDER BY cost, run LIMIT 1)"


def cluster_lines_sql(report_sql: str, cols) -> str:
    shown = " || ',' || ".join(f"printf('%.6f', {_fx(c, 6)})" for c in cols)
    return f"SELECT cluster_id AS line_no, 'Cluster ' || cluster_id || ' [' || {shown} || '] n=' || n || chr(13) AS line FROM ({report_sql})"


# --------------------------------------------------------------------- text

def stop_list_sql() -> str:
    from ..functions.text import stop_words
    return "[" + _in_list(stop_words()) + "]"


def raw_tokens_sql(text: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({text}, '[^a-zA-Z]'), "
            f"lambda t: lower(t)), lambda t: t <> '')")


def clean_tokens_sql(text: str) -> str:
    return f"list_filter({raw_tokens_sql(text)}, lambda t: NOT list_contains({stop_list_sql()}, t))"


BUCKET_OF_W = ("list_reduce(list_transform(string_split(w, ''), lambda c: ascii(c)::BIGINT), "
               "lambda h, c: (h * 31 + c) & 1048575, 0::BIGINT)")


def buckets_sql(text: str) -> str:
    return (f"list_concat([0], list_transform({clean_tokens_sql(text)}, "
            f"lambda w: CAST({BUCKET_OF_W} AS INTEGER)))")


TOKENIZE = f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(tk) AS BIGINT) AS n_tokens,
       array_to_string(tk, ' ') AS tokens
FROM (SELECT doc_id, {raw_tokens_sql('text')} AS tk FROM documents)
"""


def stopword_filter_sql() -> str:
    return f"""
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(ck) AS BIGINT) AS n_kept,
       CASE WHEN len(ck) = 0 THEN '' ELSE ' ' || array_to_string(ck, ' ') END AS cleaned
FROM (SELECT doc_id, {clean_tokens_sql('text')} AS ck FROM documents)
"""


def _doc_tf_ctes() -> str:
    return f"""
WITH tok AS MATERIALIZED (
  SELECT doc_id, unnest({buckets_sql('text')}) AS bucket FROM documents),
tf AS MATERIALIZED (SELECT doc_id, bucket, count(*) AS tf FROM tok GROUP BY doc_id, bucket),
idf AS MATERIALIZED (
  SELECT bucket, count(*) AS df,
         ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
  FROM tf GROUP BY bucket)
"""


def hash_tf_sql() -> str:
    return _doc_tf_ctes() + ("SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(bucket AS INTEGER) AS bucket, "
                             "CAST(tf AS BIGINT) AS tf FROM tf")


def idf_sql() -> str:
    return _doc_tf_ctes() + ("SELECT CAST(bucket AS INTEGER) AS bucket, CAST(df AS BIGINT) AS df, "
                             f"{_fx('idf', 6)} AS idf FROM idf")


def tfidf_sql() -> str:
    return _doc_tf_ctes() + ("SELECT CAST(tf.doc_id AS BIGINT) AS doc_id, CAST(tf.bucket AS INTEGER) AS bucket, "
                             f"{_fx('tf.tf * idf.idf', 6)} AS tfidf FROM tf JOIN idf ON tf.bucket = idf.bucket")


# -------------------------------------------------------------- naive bayes

def nb_ctes(labels=X.Q28_LABELS, idf_from: str = "test", smoothing: float = 1.0,
            num_features: int = 1 << 20) -> str:
    """TF-IDF per split, model sums, and per-class scores of the test documents,
    computed the direct way: per document v = tf * idf, S = sum of v."""
    lab = ", ".join(f"('{name}', {i})" for i, name in enumerate(labels))
    a = f"CAST({smoothing!r} AS DOUBLE)"
    if idf_from == "test":
        test_v = "SELECT doc_id, bucket, v FROM v WHERE split = 'test'"
    else:
        test_v = ("SELECT tf.doc_id, tf.bucket, tf.tf * coalesce(i.idf, "
                  "ln((SELECT n FROM nd WHERE split = 'train') + 1.0)) AS v "
                  "FROM tf LEFT JOIN idf i ON i.split = 'train' AND i.bucket = tf.bucket "
                  "WHERE tf.split = 'test'")
    return f"""
WITH docs AS MATERIALIZED ({Q28_DOCUMENTS}),
lab AS (SELECT * FROM (VALUES {lab}) t(label, idx)),
d AS MATERIALIZED (
  SELECT docs.doc_id, lab.idx AS y, docs.split, {buckets_sql('docs.text')} AS buckets
  FROM docs JOIN lab ON docs.label = lab.label),
tok AS MATERIALIZED (SELECT doc_id, y, split, unnest(buckets) AS bucket FROM d),
tf AS MATERIALIZED (SELECT doc_id, y, split, bucket, count(*) AS tf FROM tok GROUP BY doc_id, y, split, bucket),
nd AS MATERIALIZED (SELECT split, count(*) AS n FROM d GROUP BY split),
idf AS MATERIALIZED (
  SELECT tf.split, tf.bucket, ln((nd.n + 1.0) / (count(*) + 1.0)) AS idf
  FROM tf JOIN nd ON tf.split = nd.split GROUP BY tf.split, tf.bucket, nd.n),
v AS MATERIALIZED (
  SELECT tf.doc_id, tf.y, tf.split, tf.bucket, tf.tf * idf.idf AS v
  FROM tf JOIN idf ON tf.split = idf.split AND tf.bucket = idf.bucket),
cls AS MATERIALIZED (SELECT y, count(*) AS nc FROM d WHERE split = 'train' GROUP BY y),
s AS MATERIALIZED (SELECT y, bucket, sum(v) AS s FROM v WHERE split = 'train' GROUP BY y, bucket),
st AS MATERIALIZED (SELECT y, sum(s) AS st FROM s GROUP BY y),
pri AS MATERIALIZED (
  SELECT y, ln(nc + {a}) - ln((SELECT sum(nc) FROM cls) + (SELECT count(*) FROM cls) * {a}) AS pi FROM cls),
tv AS MATERIALIZED ({test_v}),
scores AS MATERIALIZED (
  SELECT t.doc_id, t.y, c.y AS cls,
         c.pi + coalesce(sum(tv.v * (ln(coalesce(s.s, 0.0) + {a}) - ln(st.st + {num_features} * {a}))), 0.0) AS score
  FROM (SELECT doc_id, y FROM d WHERE split = 'test') t
  CROSS JOIN pri c JOIN st ON st.y = c.y
  LEFT JOIN tv ON tv.doc_id = t.doc_id
  LEFT JOIN s ON s.y = c.y AND s.bucket = tv.bucket
  GROUP BY t.doc_id, t.y, c.y, c.pi),
pred AS MATERIALIZED (
  SELECT doc_id, y, min({{'n': -score, 'c': cls}}).c AS prediction FROM scores GROUP BY doc_id, y)
"""


def nb_sql(kind: str, labels=X.Q28_LABELS, idf_from: str = "test") -> str:
    ctes = nb_ctes(labels, idf_from)
    if kind == "score":
        return ctes + ("SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(y AS INTEGER) AS label, "
                       "CAST(prediction AS INTEGER) AS prediction FROM pred")
    if kind == "train":
        return ctes + ("SELECT CAST(c.y AS INTEGER) AS label, lab.label AS label_name, "
                       f"CAST(c.nc AS BIGINT) AS n_docs, {_fx('p.pi', 6)} AS pi, {_fx('st.st', 2)} AS total "
                       "FROM cls c JOIN pri p ON p.y = c.y JOIN st ON st.y = c.y JOIN lab ON lab.idx = c.y")
    if kind == "theta":
        return ctes + ("SELECT CAST(s.y AS INTEGER) AS label, CAST(s.bucket AS INTEGER) AS bucket, "
                       f"{_fx('ln(s.s + 1.0) - ln(st.st + 1048576.0)', 6)} AS theta "
                       "FROM s JOIN st ON st.y = s.y")
    summary = """
summary AS (
  SELECT CAST(count_if(y = prediction) AS BIGINT) AS correct,
         CAST(count(*) - count_if(y = prediction) AS BIGINT) AS incorrect,
         CAST(count(*) AS BIGINT) AS total,
         round_even(100.0 * count_if(y = prediction) / count(*), 4) AS pct_correct,
         round_even(100.0 * (count(*) - count_if(y = prediction)) / count(*), 4) AS pct_incorrect
  FROM pred)
"""
    cells = ", ".join(f"CAST(count_if(p.prediction = {i}) AS BIGINT) AS {name}"
                      for i, name in enumerate(labels))
    matrix = f"""
matrix AS (
  SELECT CAST(lab.idx AS INTEGER) AS label, lab.label AS label_name, {cells},
         CAST(count(p.doc_id) AS BIGINT) AS total
  FROM lab LEFT JOIN pred p ON p.y = lab.idx GROUP BY lab.idx, lab.label)
"""
    ctes = ctes + "," + summary + "," + matrix
    if kind == "summary":
        return ctes + "SELECT * FROM summary"
    if kind == "confusion":
        return ctes + "SELECT * FROM matrix"
    if kind == "report":
        return ctes + report_lines_sql(labels)
    raise ValueError(kind)


def report_lines_sql(labels) -> str:
    """The report's lines from CTEs ``summary`` and ``matrix``. The layout is stated here again, on
    purpose: nothing is shared with the operators."""
    rule, thin = "=" * 55, "-" * 55

    def left(x, width):
        return f"repeat(' ', greatest(0, {width} - length({x}))::INT) || {x}"

    def right(x, width):
        return f"{x} || repeat(' ', greatest(0, {width} - length({x}))::INT)"

    def pct(c):
        return ("coalesce(regexp_replace(regexp_replace(CAST(CAST(" + c +
                " AS DECIMAL(20,4)) AS VARCHAR), '0+$', ''), '\\.$', ''), 'NaN')")

    def text(c):
        return f"CAST({c} AS VARCHAR)"

    letters = "abcdefghijklmnopqrstuvwxyz"
    codes = [letters[i] if i < 26 else letters[i // 26] + letters[i % 26] for i in range(len(labels))]  # up to 676 classes
    header = " || ".join(f"'{c.ljust(5)}' || chr(9)" for c in codes) + " || '<--Classified as'"
    fixed = [(0, ""), (1, rule), (2, "Summary"), (3, thin), (7, ""), (8, rule), (9, "Confusion Matrix"), (10, thin)]
    fixed_sql = " UNION ALL ".join(f"SELECT {n} AS line_no, '{t}' AS line" for n, t in fixed)
    code = "[" + ", ".join(f"'{c}'" for c in codes) + "][label + 1]"
    cells = " || ".join(f"{right(text(name), 5)} || chr(9)" for name in labels)
    caption = {c: f"'{c.ljust(40)}: '" for c in ("Correctly Classified Instances", "Incorrectly Classified Instances",
                                                  "Total Classified Instances")}
    good, bad, every = caption.values()
    return f"""
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM (
  {fixed_sql}
  UNION ALL SELECT 11, {header}
  UNION ALL SELECT 4, {good} || {left(text('correct'), 10)} || chr(9) || {left(pct('pct_correct'), 10)} || '%' FROM summary
  UNION ALL SELECT 5, {bad} || {left(text('incorrect'), 10)} || chr(9) || {left(pct('pct_incorrect'), 10)} || '%' FROM summary
  UNION ALL SELECT 6, {every} || {left(text('total'), 10)} FROM summary
  UNION ALL SELECT label * 2 + 12, {cells} || ' |  ' || {right(text('total'), 6)} || chr(9) || {right(code, 5)} || ' = ' || label_name FROM matrix
  UNION ALL SELECT label * 2 + 13, '' FROM matrix)
"""


def wide_report_sql() -> str:
    """A report whose counts are quantities of order lines, in hundredths."""
    cells = ", ".join(f"CAST(coalesce(sum(n) FILTER (p = {i}), 0) AS BIGINT) AS {c}" for i, c in enumerate("ANR"))
    return f"""
WITH cell AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, l_linenumber % 3 AS p,
         sum(CAST(round(l_quantity * 100) AS BIGINT)) AS n FROM lineitem GROUP BY 1, 2
), totals AS (
  SELECT CAST(coalesce(sum(n) FILTER (y = p), 0) AS BIGINT) AS correct, CAST(sum(n) AS BIGINT) AS total FROM cell
), summary AS (
  SELECT correct, total - correct AS incorrect, total, round_even(100.0::DOUBLE * correct / total, 4) AS pct_correct,
         round_even(100.0::DOUBLE * (total - correct) / total, 4) AS pct_incorrect FROM totals
), matrix AS (
  SELECT y AS label, ['A', 'N', 'R'][y + 1] AS label_name, {cells}, CAST(sum(n) AS BIGINT) AS total FROM cell GROUP BY y
)""" + report_lines_sql(["A", "N", "R"])


# ----------------------------------------------------------------- logistic

def _dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def logistic_ctes(features_sql: str, cols, label: str = "label", passes: int = 20,
                  rate: float = 1.0, lam: float = 0.1) -> str:
    """One CTE pair per pass: the mean gradient g{i}, then the L1 step w{i}."""
    import math
    cols = list(cols)
    names = [f"w_{j}" for j in range(len(cols))] + ["b"]
    init = ", ".join([f"CAST(0.0 AS DOUBLE) AS w_{j}" for j in range(len(cols))] + ["CAST(1.0 AS DOUBLE) AS b"])
    parts = [f"d AS MATERIALIZED (SELECT {', '.join(cols)}, CAST({label} AS DOUBLE) AS y FROM ({features_sql}))",
             f"w0 AS MATERIALIZED (SELECT {init})"]
    for i in range(1, passes + 1):
        z = " + ".join(f"w.w_{j} * d.{c}" for j, c in enumerate(cols)) + " + w.b"
        err = f"(1.0 / (1.0 + exp(-({z}))) - d.y)"
        grads = ", ".join([f"sum({err} * d.{c}) / count(*) AS w_{j}" for j, c in enumerate(cols)]
                          + [f"sum({err}) / count(*) AS b"])
        parts.append(f"g{i} AS MATERIALIZED (SELECT {grads} FROM d CROSS JOIN w{i - 1} w)")
        step = rate / math.sqrt(i)
        shrink = lam * step
        upd = ", ".join(
            f"sign(w.{n} - {_dbl(step)} * g.{n}) * greatest(abs(w.{n} - {_dbl(step)} * g.{n}) - {_dbl(shrink)}, 0.0) AS {n}"
            for n in names)
        parts.append(f"w{i} AS MATERIALIZED (SELECT {upd} FROM w{i - 1} w CROSS JOIN g{i} g)")
    return "WITH " + ",\n".join(parts)


def logistic_sql(kind: str, features_sql: str, key: str, cols, passes: int, rate: float,
                 lam: float) -> str:
    cols = list(cols)
    ctes = logistic_ctes(features_sql, cols, "label", passes, rate, lam)
    last = f"w{passes}"
    if kind == "train":
        terms = " UNION ALL ".join(
            [f"SELECT '{c}' AS term, {_fx(f'w_{j}', 6)} AS weight FROM {last}" for j, c in enumerate(cols)]
            + [f"SELECT 'intercept' AS term, {_fx('b', 6)} AS weight FROM {last}"])
        return ctes + "\n" + terms
    z = " + ".join(f"w.w_{j} * f.{c}" for j, c in enumerate(cols)) + " + w.b"
    scored = (f", scored AS MATERIALIZED (SELECT f.{key}, CAST(f.label AS DOUBLE) AS label, "
              f"1.0 / (1.0 + exp(-({z}))) AS probability, "
              f"CAST(CASE WHEN 1.0 / (1.0 + exp(-({z}))) > 0.5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction "
              f"FROM ({features_sql}) f CROSS JOIN {last} w)\n")
    if kind == "score":
        return ctes + scored + (f"SELECT CAST({key} AS BIGINT) AS {key}, label, {_fx('probability', 6)} AS probability, "
                                f"prediction FROM scored")
    if kind == "accuracy":
        return ctes + scored + f"SELECT {_fx('avg(CAST(prediction = label AS DOUBLE))', 6)} AS accuracy FROM scored"
    if kind == "confusion":
        return ctes + scored + ("SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted, "
                                "CAST(count(s.label) AS BIGINT) AS n FROM (SELECT unnest([0, 0, 1, 1]) AS a, unnest([0, 1, 0, 1]) AS p) "
                                "LEFT JOIN scored s ON s.label = a AND s.prediction = p GROUP BY a, p")
    if kind == "auc":
        return ctes + scored + f""",
by_score AS (SELECT probability AS s, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                    sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY probability),
cum AS (SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS neg_below FROM by_score)
SELECT {_fx("sum(pos * (neg_below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg))", 6)} AS auc FROM cum"""
    if kind == "report":
        return ctes + scored + f"""
SELECT 'accuracy' AS metric, CAST(-1 AS INTEGER) AS actual, CAST(-1 AS INTEGER) AS predicted,
       {_fx("avg(CAST(prediction = label AS DOUBLE))", 6)} AS value,
       printf('%.2f', avg(CAST(prediction = label AS DOUBLE))) AS text FROM scored
UNION ALL
SELECT 'confusion', CAST(a AS INTEGER), CAST(p AS INTEGER), CAST(count(s.label) AS DOUBLE),
       '' FROM (SELECT unnest([0, 0, 1, 1]) AS a, unnest([0, 1, 0, 1]) AS p)
       LEFT JOIN scored s ON s.label = a AND s.prediction = p GROUP BY a, p"""
    raise ValueError(kind)


# ------------------------------------------------------------------ readers


def vector_logistic_sql(kind: str, passes: int, rate: float, lam: float) -> str:
    """The fit on the entries of ``embeddings`` against label >= 5, in long form: a row for each vector and entry."""
    import math
    parts = ["v AS MATERIALIZED (SELECT vec_id, CAST(label >= 5 AS DOUBLE) AS y, [CAST(e AS DOUBLE) FOR e IN embedding] AS x FROM embeddings)",
             f"""long AS MATERIALIZED (SELECT vec_id, y, j, x[j + 1] AS x FROM v CROSS JOIN (SELECT unnest(range({VECTOR_WIDTH})) AS j)
      UNION ALL SELECT vec_id, y, {VECTOR_WIDTH}, 1.0 FROM v)""",
             f"w0 AS MATERIALIZED (SELECT j, CAST(j = {VECTOR_WIDTH} AS DOUBLE) AS w FROM (SELECT unnest(range({VECTOR_WIDTH + 1})) AS j))"]
    for i in range(1, passes + 1):
        step = rate / math.sqrt(i)
        moved = f"(w.w - {_dbl(step)} * g.g)"
        parts += [f"e{i} AS MATERIALIZED (SELECT vec_id, 1.0 / (1.0 + exp(-sum(l.x * w.w))) - any_value(l.y) AS e FROM long l JOIN w{i - 1} w USING (j) GROUP BY vec_id)",
                  f"g{i} AS MATERIALIZED (SELECT j, sum(e.e * l.x) / count(*) AS g FROM long l JOIN e{i} e USING (vec_id) GROUP BY j)",
                  f"w{i} AS MATERIALIZED (SELECT j, sign({moved}) * greatest(abs({moved}) - {_dbl(lam * step)}, 0.0) AS w FROM w{i - 1} w JOIN g{i} g USING (j))"]
    ctes = "WITH " + ",\n".join(parts)
    if kind == "train":
        return ctes + f"\nSELECT CASE WHEN j = {VECTOR_WIDTH} THEN 'intercept' ELSE 'x' || j END AS term, {_fx('w', 6)} AS weight FROM w{passes}"
    scored = f"""\nSELECT vec_id, any_value(l.y) AS label, 1.0 / (1.0 + exp(-sum(l.x * w.w))) AS p FROM long l JOIN w{passes} w USING (j) GROUP BY vec_id"""
    return f"SELECT CAST(vec_id AS BIGINT) AS vec_id, label, {_fx('p', 6)} AS probability, CAST(p > 0.5 AS DOUBLE) AS prediction FROM ({ctes + scored})"


def comma_lines_sql() -> str:
    return f"""
WITH rows AS (SELECT f.*, c.c_acctbal, c.c_mktsegment FROM ({Q05_FEATURES}) f
              JOIN customer c ON f.c_customer_sk = c.c_custkey),
lines AS (
  SELECT concat_ws(',', CAST(c_customer_sk AS VARCHAR),
                   CASE WHEN c_mktsegment = 'FURNITURE' THEN ' ' || CAST(flag_balance AS VARCHAR) || ' '
                        ELSE CAST(flag_balance AS VARCHAR) END,
                   CAST(flag_segment AS VARCHAR), CAST(label AS VARCHAR)) AS value FROM rows
  UNION ALL SELECT concat_ws(',', CAST(c_customer_sk AS VARCHAR), '', CAST(flag_segment AS VARCHAR),
                   CAST(label AS VARCHAR)) FROM rows WHERE c_acctbal < 0
  UNION ALL SELECT concat_ws(',', CAST(c_customer_sk AS VARCHAR), CAST(flag_balance AS VARCHAR),
                   CAST(flag_segment AS VARCHAR)) FROM rows WHERE c_mktsegment = 'HOUSEHOLD'
  UNION ALL SELECT 'c_customer_sk,college_education,male,label'),
parsed AS (
  SELECT string_split(value, ',')[1] AS c_customer_sk,
         try_cast(string_split(value, ',')[2] AS DOUBLE) AS college_education,
         try_cast(string_split(value, ',')[3] AS DOUBLE) AS male,
         try_cast(string_split(value, ',')[4] AS DOUBLE) AS label
  FROM lines)
"""


def parse_comma_sql(kind: str) -> str:
    ok = "college_education IS NOT NULL AND male IS NOT NULL AND label IS NOT NULL"
    if kind == "good":
        return comma_lines_sql() + f"SELECT * FROM parsed WHERE {ok}"
    return comma_lines_sql() + f"SELECT CAST(count(*) AS BIGINT) AS n_rejected FROM parsed WHERE NOT ({ok})"


def parse_observed_sql() -> str:
    ok = "college_education IS NOT NULL AND male IS NOT NULL AND label IS NOT NULL"
    return comma_lines_sql() + (f"SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM parsed) AS n_lines, "
                                f"(SELECT CAST(count(*) AS BIGINT) FROM parsed WHERE NOT ({ok})) AS n_rejected FROM parsed WHERE {ok}")


def read_rejects_sql() -> str:
    field = "try_cast(string_split(value, ',')[{}] AS DOUBLE) IS NULL"
    return comma_lines_sql() + f""", numbered AS (
  SELECT value, right(string_split(value, ',')[1], 1) AS digit,
         row_number() OVER (PARTITION BY right(string_split(value, ',')[1], 1) ORDER BY value) AS line_no FROM lines)
SELECT digit, line_no, value AS line, line_no = 1 AND value = 'c_customer_sk,college_education,male,label' AS is_header
FROM numbered WHERE {" OR ".join(field.format(i) for i in (2, 3, 4))}"""


def parse_space_sql(with_bad: bool) -> str:
    cols = ["order_ratio", "item_ratio", "amount_ratio", "returns"]
    xs = ", ".join(f"try_cast(string_split(regexp_replace(value, ' +$', ''), ' ')[{i + 1}] AS DOUBLE) AS x{i}"
                   for i in range(len(cols)))
    bad = ""
    if with_bad:
        bad = ("UNION ALL SELECT array_to_string([" + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
               + "], '  ') FROM f WHERE returns = 0")
    vals = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"""
WITH f AS ({Q20_FEATURES}),
lines AS (
  SELECT CASE WHEN returns = 0 THEN concat_ws(' ', {vals}) || ' ' ELSE concat_ws(' ', {vals}) END AS value FROM f
  {bad})
SELECT x0, x1, x2, x3 FROM (SELECT {xs},
  len(string_split(regexp_replace(value, ' +$', ''), ' ')) AS n FROM lines)
WHERE n = {len(cols)} AND x0 IS NOT NULL AND x1 IS NOT NULL AND x2 IS NOT NULL AND x3 IS NOT NULL
"""


def parse_space_rejects_sql() -> str:
    good = parse_space_sql(True)
    return f"""
SELECT CAST((SELECT count(*) FROM ({Q20_FEATURES}) f) + (SELECT count(*) FROM ({Q20_FEATURES}) f WHERE returns = 0)
            - (SELECT count(*) FROM ({good})) AS BIGINT) AS n_rejected
"""


def parse_tab_sql(kind: str, labels=X.Q28_LABELS) -> str:
    lab = "[" + _in_list(labels) + "]"
    base = f"""
WITH lines AS (
  SELECT CASE WHEN d.lang = 'de' THEN line || chr(9) WHEN d.lang = 'es' THEN line || chr(9) || 'x' ELSE line END
         AS value
  FROM (SELECT d.lang, concat_ws(chr(9), CAST(d.doc_id AS VARCHAR),
               CASE WHEN d.lang = 'fr' THEN lower(lb) ELSE lb END,
               regexp_replace(d.text, '[\\t\\r\\n]+', ' ', 'g')) AS line
        FROM documents d JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'NEG' WHEN quality = 1 THEN 'POS'
                                                   ELSE 'NEU' END AS lb FROM labels) l
          ON d.doc_id = l.doc_id) d),
parsed AS (
  SELECT f[1] AS review_id, f[2] AS label, CAST(list_position({lab}, f[2]) - 1 AS INTEGER) AS label_index,
         f[3] AS text, len(f) AS n
  FROM (SELECT string_split(regexp_replace(value, '\\t+$', ''), chr(9)) AS f FROM lines))
"""
    ok = "n = 3 AND text <> '' AND coalesce(label_index, -1) >= 0"
    if kind == "good":
        return base + f"SELECT review_id, label, label_index, text FROM parsed WHERE {ok}"
    return base + f"SELECT CAST(count(*) AS BIGINT) AS n_rejected FROM parsed WHERE NOT ({ok})"
