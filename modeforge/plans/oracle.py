"""The queries of the catalog once more, as plain SQL for another engine.

Written from the definitions, with none of the expressions of the package: the
digamma terms, the updates of the fit and the draws are spelled out in SQL.
"""

from __future__ import annotations

from modeforge.operators.model import Mixture
from modeforge.plans import samples

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
MARKER = "-9999999.0"


def r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


def uniform(purpose: str, *keys: str) -> str:
    parts = ", ".join([f"'{purpose}:42'", *(f"CAST({k} AS VARCHAR)" for k in keys)])
    digits = f"substr(md5(concat_ws('|', {parts})), 1, 8)"
    return f"((CAST(('0x' || {digits}) AS BIGINT) + 0.5) / 4294967296.0)"


def digamma(x: str) -> str:
    """Recurrence by 8 and the asymptotic series."""
    y = f"(({x}) + 8.0)"
    down = " - ".join(f"1.0/(({x}) + {i}.0)" for i in range(8))
    return (
        f"(ln({y}) - 0.5/{y} - 1.0/(12.0*pow({y},2)) + 1.0/(120.0*pow({y},4)) "
        f"- 1.0/(252.0*pow({y},6)) + 1.0/(240.0*pow({y},8)) - {down})"
    )


def log_constant(m: Mixture, k: int) -> str:
    """Constant of the expected log density of a given component."""
    terms = [
        f"-0.5*(ln(2.0*pi()) + ln({m.variances[k]!r}) + ln({m.nu[k]!r}))",
        f"0.5*(ln(2.0) + {digamma(repr(0.5 * m.nu[k]))} - 1.0/{m.beta[k]!r})",
        digamma(repr(m.a[k])),
        f"-{digamma(repr(m.a[k] + m.b[k]))}",
    ]
    for j in range(k):
        terms.append(f"{digamma(repr(m.b[j]))} - {digamma(repr(m.a[j] + m.b[j]))}")
    return "(" + " + ".join(terms) + ")"


def scored(m: Mixture, source: str, x: str = "x") -> str:
    """Responsibilities ``r*`` and log densities ``l*`` of every row of ``source``."""
    ks = range(m.size)
    logs = ", ".join(
        f"{log_constant(m, k)} - 0.5*({x} - {m.means[k]!r})*({x} - {m.means[k]!r})/{m.variances[k]!r} AS l{k}"
        for k in ks
    )
    top = f"greatest({', '.join(f'l{k}' for k in ks)})" if m.size > 1 else "l0"
    parts = ", ".join(f"exp(l{k} - top) AS e{k}" for k in ks)
    whole = " + ".join(f"e{k}" for k in ks)
    return (
        f"SELECT *, {', '.join(f'e{k}/({whole}) AS r{k}' for k in ks)}, top + ln({whole}) AS norm "
        f"FROM (SELECT *, {parts} FROM (SELECT *, {top} AS top FROM "
        f"(SELECT *, {logs} FROM ({source}))))"
    )


def coded(m: Mixture, source: str, u: str, x: str = "x") -> str:
    """Drawn mode ``z`` (among the active) and unclipped value ``n`` of every row."""
    kept = [k for k in range(m.size) if m.active[k]]
    whole = " + ".join(f"(r{k} + 1e-6)" for k in kept)
    sums = [" + ".join(f"(r{k} + 1e-6)" for k in kept[: i + 1]) for i in range(len(kept))]
    whens = " ".join(f"WHEN {u} < ({s})/({whole}) THEN {i}" for i, s in enumerate(sums[:-1]))
    draw = f"CASE WHEN {x} IS NULL THEN NULL {whens} ELSE {len(kept) - 1} END"
    mean = " ".join(f"WHEN {i} THEN {m.means[k]!r}" for i, k in enumerate(kept))
    width = " ".join(f"WHEN {i} THEN 4.0*sqrt({m.variances[k]!r})" for i, k in enumerate(kept))
    return (
        f"SELECT *, ({x} - mu)/width AS n FROM (SELECT *, CASE z {mean} END AS mu, "
        f"CASE z {width} END AS width FROM (SELECT *, {draw} AS z FROM ({scored(m, source, x)})))"
    )


def exactly(m: Mixture) -> str:
    """The decoded value of ``coded`` rows, in the order of operations that a lossless trip has to repeat."""
    kept = [k for k in range(m.size) if m.active[k]]
    width = [4.0 * m.variances[k] ** 0.5 for k in kept]
    inverse = " ".join(f"WHEN {i} THEN {1.0 / w!r}::DOUBLE" for i, w in enumerate(width))
    wide = " ".join(f"WHEN {i} THEN {w!r}::DOUBLE" for i, w in enumerate(width))
    mean = " ".join(f"WHEN {i} THEN {m.means[k]!r}::DOUBLE" for i, k in enumerate(kept))
    n = f"least(0.99::DOUBLE, greatest(-0.99::DOUBLE, (value - CASE z {mean} END)*CASE z {inverse} END))"
    return f"({n}*CASE z {wide} END + CASE z {mean} END)"


CLIPPED = "CASE WHEN n IS NOT NULL THEN least(0.99, greatest(-0.99, n)) END"


def hot(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS DOUBLE)"


EVENTS = "SELECT event_id, value, value AS x FROM events"
EVENT_CODED = coded(samples.EVENT_VALUE, EVENTS, uniform("mode:value", "event_id"))
EVENT_DECODED = (
    f"SELECT event_id, value, round({CLIPPED}*width + mu, 6) + 0.0 AS decoded FROM ({EVENT_CODED})"
)
EVENT_ORDER = (1, 0, 2)


# ---------------------------------------------------------------- fitting


def fit(source: str, components: int, steps: int) -> str:
    """CTEs of a fit: ``posterior_<x>`` holds the parameters after ``steps``."""
    k = components
    held = "(n + 2.220446049250313e-15)"
    updated = f"""
        SELECT it, k, mean, variance, beta, nu, a, b,
          -0.5*(ln(2.0*pi()) + ln(variance) + ln(nu))
          + 0.5*(ln(2.0) + {digamma('0.5*nu')} - 1.0/beta) + {digamma('a')} - {digamma('a + b')}
          + coalesce(sum({digamma('b')} - {digamma('a + b')}) OVER (
              PARTITION BY it ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)
          AS c
        FROM (
          SELECT it, k, 1.0 + held AS beta, 1.0 + held AS nu, 1.0 + held AS a,
            0.001 + coalesce(sum(held) OVER (PARTITION BY it ORDER BY k
              ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0.0) AS b,
            held*centre/(1.0 + held) AS mean,
            greatest((1.0 + held*spread + held/(1.0 + held)*centre*centre)/(1.0 + held), reg)
              AS variance
          FROM (
            SELECT it, k, held, centre, reg,
              greatest(s2 - 2.0*centre*s1 + centre*centre*n, 0.0)/held + reg AS spread
            FROM (SELECT it, k, n, s1, s2, {held} AS held, s1/{held} AS centre, reg
                  FROM (FROM_EM), (SELECT 1e-6/(scale*scale) AS reg FROM measures))))"""
    logs = "c - 0.5*(z - mean)*(z - mean)/variance"
    step = updated.replace("FROM_EM", f"SELECT * FROM em WHERE it < {steps}")
    return f"""
      raw AS ({source}),
      measures AS (SELECT avg(x) AS centre0, sqrt(var_samp(x)) AS scale, count(*) AS rows FROM raw),
      grouped AS (SELECT x, CAST(count(*) AS DOUBLE) AS n FROM raw GROUP BY x),
      cells AS (SELECT (x - centre0)/scale AS z, n,
          least({k - 1}, floor((sum(n) OVER (ORDER BY x) - n/2.0)/rows*{k})) AS bin
        FROM grouped, measures),
      start AS (SELECT k, coalesce(sum(n), 0.0) AS n, coalesce(sum(n*z), 0.0) AS s1,
          coalesce(sum(n*z*z), 0.0) AS s2
        FROM range({k}) AS t(k) LEFT JOIN cells ON bin = k GROUP BY k),
      em AS (
        SELECT 0 AS it, k, n, s1, s2 FROM start
        UNION ALL
        SELECT it + 1, k, sum(n*p), sum(n*p*z), sum(n*p*z*z) FROM (
          SELECT it, k, z, n, e/sum(e) OVER (PARTITION BY z) AS p FROM (
            SELECT it, k, z, n, exp(l - max(l) OVER (PARTITION BY z)) AS e FROM (
              SELECT it, k, z, n, {logs} AS l FROM cells, ({step}))))
        GROUP BY it, k),
      last_step AS ({updated.replace("FROM_EM", f"SELECT * FROM em WHERE it = {steps}")}),
      posterior AS (SELECT *, share/sum(share) OVER () AS weight FROM (
        SELECT *, a/(a + b)*exp(coalesce(sum(ln(b/(a + b))) OVER (
          ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS share
        FROM last_step)),
      shares AS (SELECT k, z, n, l, top, weight, e/sum(e) OVER (PARTITION BY z) AS p FROM (
        SELECT *, exp(l - top) AS e FROM (
          SELECT *, max(l) OVER (PARTITION BY z) AS top FROM (
            SELECT k, z, n, weight, {logs} AS l FROM cells, posterior)))),
      wins AS (SELECT k, weight > 0.005 AND sum(CASE WHEN l = top THEN n ELSE 0 END) > 0 AS active
        FROM shares GROUP BY k, weight),
      drawn AS (SELECT k, sum(n*q/whole) AS frequency FROM (
          SELECT k, n, p + 1e-6 AS q, sum(p + 1e-6) OVER (PARTITION BY z) AS whole
          FROM shares JOIN wins USING (k) WHERE active)
        GROUP BY k)"""


def fitted(label: str, source: str, components: int, steps: int, digits: int) -> str:
    return f"""
      WITH RECURSIVE {fit(source, components, steps)}
      SELECT '{label}' AS "column", CAST(k AS INT) AS k, {r('weight', digits)} AS weight,
        {r('centre0 + scale*mean', digits)} AS mean,
        {r('scale*scale*variance', digits)} AS variance, active,
        {r('coalesce(frequency, 0.0)', digits)} AS frequency,
        CAST(CASE WHEN active THEN row_number() OVER (
          PARTITION BY active ORDER BY frequency DESC, k) - 1 END AS INT) AS rank
      FROM posterior JOIN wins USING (k) LEFT JOIN drawn USING (k), measures"""


def table_of_fits(parts: dict[str, str], components: int, steps: int, digits: int) -> str:
    columns = '"column", k, weight, mean, variance'
    return " UNION ALL ".join(
        f"SELECT {columns} FROM ({fitted(label, source, components, steps, digits)})"
        for label, source in parts.items()
    )


# --------------------------------------------------------------- encoding

ROWS_OF_LINE = f"SELECT {LINE_KEY}, l_extendedprice, l_discount, l_returnflag, l_linestatus FROM lineitem"
PRICE = coded(
    samples.EXTENDED_PRICE,
    f"SELECT *, l_extendedprice AS x FROM ({ROWS_OF_LINE})",
    uniform("mode:l_extendedprice", *LINE_KEY.split(", ")),
)
PRICE = (
    f"SELECT {LINE_KEY}, l_discount, l_returnflag, l_linestatus, {CLIPPED} AS pn, z AS pz, "
    f"{CLIPPED}*width + mu AS price FROM ({PRICE})"
)
BOTH = coded(
    samples.DISCOUNT,
    f"SELECT *, CASE WHEN l_discount = 0.0 THEN NULL ELSE l_discount END AS x FROM ({PRICE})",
    uniform("mode:l_discount", *LINE_KEY.split(", ")),
)
ZERO_NORM = "((0.0 - 0.002)/(4.0*sqrt(0.00001)))"
BOTH = (
    f"SELECT *, CASE WHEN l_discount = 0.0 THEN {ZERO_NORM} ELSE {CLIPPED} END AS dn, "
    f"CASE WHEN l_discount = 0.0 THEN 0.0 ELSE {CLIPPED}*width + mu END AS discount FROM ({BOTH})"
)


def ranked(column: str, table: str) -> str:
    return (
        f"SELECT {column} AS value, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS idx "
        f"FROM {table} GROUP BY {column}"
    )


def with_rank(source: str, column: str, table: str) -> str:
    return (
        f"SELECT s.*, d.idx AS rank_{column} FROM ({source}) s "
        f"LEFT JOIN ({ranked(column, table)}) d ON s.{column} = d.value"
    )


def one_hot(index: str, width: int, first: int) -> str:
    return ", ".join(f"{hot(f'{index} = {i}')} AS col_{first + i}" for i in range(width))


MIXED_EVENTS = (
    "SELECT event_id, v, CASE WHEN v IN (0.01, -9999999.0) THEN NULL ELSE v END AS x FROM ("
    f"SELECT event_id, CASE WHEN event_type = 'error' THEN {MARKER} ELSE value END AS v FROM events)"
)
MIXED_CODED = coded(samples.EVENT_VALUE, MIXED_EVENTS, uniform("mode:v", "event_id"))
MIXED_NORM = (
    "CASE WHEN v = 0.01 THEN (0.01 - 12.0)/(4.0*sqrt(60.0)) "
    f"WHEN v = {MARKER} THEN 0.0 ELSE {CLIPPED} END"
)
# Natural positions of the mixed block: two modal values, then three modes.
MIXED_POSITIONS = ("v = 0.01", f"v = {MARKER}", "z = 0", "z = 1", "z = 2")
MIXED_ORDER = (3, 1, 2, 4, 0)

SCALED = "2.0*({x} - lo)/(hi - lo) - 1.0"


def scaled(column: str) -> str:
    low, high = (f"(SELECT {f}({column}) FROM lineitem)" for f in ("min", "max"))
    return f"(({column} - {low})/({high} - {low})*2.0 - 1.0)"


def described(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {r(f'avg({c})', 4)} AS mean,
          {r(f'stddev_samp({c})', 4)} AS stddev, {r(f'min({c})', 4)} AS min,
          {r(f'max({c})', 4)} AS max FROM lineitem"""
        for c in columns
    )


def skewness(x: str) -> str:
    """Population skewness."""
    return f"((avg({x}*{x}*{x}) - 3*avg({x})*avg({x}*{x}) + 2*pow(avg({x}), 3))/pow(stddev_pop({x}), 3))"


def ks(source: str) -> str:
    """Statistic from ``source`` (x, a, b): counts of either sample per row."""
    return f"""
      SELECT max(abs(fa/n - fb/m)) AS statistic, max(n) AS n, max(m) AS m FROM (
        SELECT sum(a) OVER w AS fa, sum(b) OVER w AS fb, CAST(sum(a) OVER () AS BIGINT) AS n,
          CAST(sum(b) OVER () AS BIGINT) AS m
        FROM (SELECT x, sum(a) AS a, sum(b) AS b FROM ({source}) GROUP BY x)
        WINDOW w AS (ORDER BY x))"""


MOMENT_GAPS = ", ".join(
    f"abs({x} - {y}) AS {name}"
    for name, x, y in (
        ("mean", "avg(value)", "avg(decoded)"),
        ("std", "stddev_pop(value)", "stddev_pop(decoded)"),
        ("skew", skewness("value"), skewness("decoded")),
        ("kurtosis", "kurtosis_pop(value)", "kurtosis_pop(decoded)"),
    )
)
MOMENTS_VALID = "mean < 0.05 AND std < 0.05 AND skew < 0.05 AND kurtosis < 0.05"
BOUNDS_VALID = (
    "(SELECT bool_and(decoded BETWEEN lo AND hi) FROM decoded_events, "
    "(SELECT min(value) AS lo, max(value) AS hi FROM events))"
)

JITTERED = (
    "SELECT {keys}, {x} + ({u} - 0.5)*(SELECT stddev_samp({x}) FROM {table})*0.1 AS {x} FROM {rows}"
)


def copies(target: int) -> str:
    """Copies of the events needed for a target."""
    return (
        "(SELECT event_id, value, copy FROM events, "
        f"range((SELECT CAST(greatest(1, ceil({target}/count(*))) AS BIGINT) FROM events)) AS t(copy))"
    )


def inflated(target: int) -> str:
    return JITTERED.format(
        keys="event_id, copy",
        x="value",
        u=uniform("jitter", "event_id", "copy"),
        table="events",
        rows=copies(target),
    )


WHOLE_DISCOUNT = f"""
    WITH RECURSIVE {fit("SELECT l_discount AS x FROM lineitem", 4, 100)}
    SELECT centre0 + scale*mean AS mean, scale*scale*variance AS variance FROM posterior, measures"""
WITH_GAPS = """(SELECT event_id, CASE WHEN event_type = 'error' THEN 'nan'::DOUBLE
    WHEN event_id % 100 = 7 THEN 'inf'::DOUBLE WHEN event_id % 100 = 8 THEN NULL ELSE value END AS value
    FROM events)"""
FINITE = "CASE WHEN isfinite(value) THEN value END"


def tested(source: str) -> str:
    """Statistic, p-value of the limiting distribution and verdict."""
    return f"""WITH test AS ({ks(source)}), series AS (
        SELECT statistic, n, m, sum((CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END)
          *exp(-2.0*j*j*statistic*statistic*n*m/(n + m))) AS p, sqrt(n*m/(n + m))*statistic AS scaled
        FROM test, range(1, 101) AS t(j) GROUP BY ALL),
      bounded AS (SELECT *, CASE WHEN scaled < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, p)) END AS p_value FROM series)
      SELECT {r('statistic')} AS statistic, {r('p_value')} AS p_value, p_value > 0.05 AS valid, n, m FROM bounded"""


def oracle_queries() -> dict[str, str]:
    m = samples.EVENT_VALUE
    line_u = uniform("jitter", *LINE_KEY.split(", "))
    order_hot = ", ".join(
        f"{hot(f'z = {k}')} AS ranked_{i}" for i, k in enumerate(EVENT_ORDER)
    )
    ranked_place = " ".join(f"WHEN {k} THEN {i}" for i, k in enumerate(EVENT_ORDER))
    stats = ", ".join(
        f"{r(f'sum(r{k})', 3)} AS n{k}, {r(f'sum(r{k}*x)', 3)} AS s{k}, {r(f'sum(r{k}*x*x)', 3)} AS q{k}"
        for k in range(m.size)
    )
    entropy = " + ".join(f"r{k}*(l{k} - norm)" for k in range(m.size))
    event_scored = scored(m, EVENTS)
    component = (
        "CASE greatest(l0, l1, l2, l3) WHEN l0 THEN 0 WHEN l1 THEN 1 WHEN l2 THEN 2 ELSE 3 END"
    )
    smoothed_whole = "(r0 + r1 + r2 + 3e-6)"
    sticks = [m.a[k] / (m.a[k] + m.b[k]) for k in range(4)]
    left = [1.0]
    for k in range(3):
        left.append(left[-1] * m.b[k] / (m.a[k] + m.b[k]))
    heavy = [s * v for s, v in zip(sticks, left)]
    weight = ", ".join(f"({k}, {heavy[k]!r}/({' + '.join(map(repr, heavy))}))" for k in range(4))
    table_ranked = with_rank(
        with_rank(BOTH, "l_linestatus", "lineitem"), "l_returnflag", "lineitem"
    )
    minmax_ranked = with_rank(
        with_rank("SELECT * FROM lineitem", "l_linestatus", "lineitem"), "l_returnflag", "lineitem"
    )
    category_list = (
        "(SELECT string_agg(value, ',' ORDER BY idx) FROM ({}))".format
    )
    return {
        "csv_scan": "SELECT event_id, event_type, value FROM events",
        "csv_scan_inferred": "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer",
        "parquet_scan": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
        "sampled_scan": f"""SELECT o_orderkey, o_totalprice FROM orders
            WHERE {uniform('sample', 'o_orderkey')} < 0.1""",
        "parquet_sink": f"SELECT {LINE_KEY}, l_extendedprice FROM lineitem",
        "checked_write": """SELECT count(*) AS rows, count(*) AS rows_read_back, TRUE AS complete
            FROM lineitem""",
        "checked_write_contents": """SELECT count(*) AS rows, count(*) AS rows_read_back, TRUE AS complete, TRUE AS same,
            TRUE AS same_in_other_order, FALSE AS same_when_changed FROM lineitem""",
        "column_projection": "SELECT l_extendedprice FROM lineitem",
        "computed_projection": f"""SELECT {LINE_KEY}, {r('l_extendedprice', 4)} AS l_extendedprice
            FROM ({JITTERED.format(keys=LINE_KEY, x='l_extendedprice', u=line_u,
                                   table='lineitem', rows='lineitem')})""",
        "modal_filter": f"""SELECT l_discount IN (0.0, 0.1) AS modal, count(*) AS rows,
            {r('min(l_discount)')} AS low, {r('max(l_discount)')} AS high
            FROM lineitem GROUP BY 1""",
        "round_robin_partitions": "SELECT CAST(16 AS BIGINT) AS partitions, count(*) AS rows FROM lineitem",
        "held_histogram": """SELECT l_extendedprice, count(*) AS count,
            (SELECT count(DISTINCT l_extendedprice) FROM lineitem) AS cells
            FROM lineitem GROUP BY 1""",
        "sample_of_exact_size": f"""SELECT event_id, value FROM events
            ORDER BY {uniform('sample', 'event_id')}, event_id LIMIT 1000""",
        "row_capped_sample": f"""SELECT o_orderkey, o_totalprice FROM orders
            WHERE {uniform('sample', 'o_orderkey')} <
              (SELECT least(5000, count(*))/CAST(count(*) AS DOUBLE) FROM orders)""",
        "union_of_copies": "SELECT event_id, value, copy FROM events, range(3) AS t(copy)",
        "distinct_categories": "SELECT DISTINCT o_orderpriority FROM orders",
        "bucketed_group_key": """SELECT CAST(trunc(trunc(c_acctbal)/1000) AS BIGINT) AS bucket,
            count(*) AS rows FROM customer GROUP BY 1""",
        "row_count": "SELECT count(*) AS rows FROM lineitem",
        "describe": described(["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
        "mean_and_stddev": f"""SELECT {r('avg(l_extendedprice)', 4)} AS mean,
            {r('stddev_samp(l_extendedprice)', 4)} AS stddev FROM lineitem""",
        "column_min_max": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max FROM lineitem"
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ),
        "ranked_categories": " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS count,
                row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS idx
                FROM orders GROUP BY {c}"""
            for c in ("o_orderstatus", "o_orderpriority")
        ),
        "indexed_categories": """SELECT CAST(l_partkey AS VARCHAR) AS value,
            row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS idx
            FROM lineitem GROUP BY l_partkey""",
        "column_moments": f"""SELECT {r('avg(value)', 4)} AS mean, {r('stddev_pop(value)', 4)} AS std,
            {r(skewness('value'), 4)} AS skew, {r('kurtosis_pop(value)', 4)} AS kurtosis
            FROM events""",
        "sufficient_statistics": f"""SELECT {stats}, {r(f'-sum({entropy})', 3)} AS entropy
            FROM ({event_scored})""",
        "mode_frequency": f"""SELECT z AS mode, count(*) AS count,
            CAST(row_number() OVER (ORDER BY count(*) DESC, z) - 1 AS INT) AS rank
            FROM ({EVENT_CODED}) GROUP BY z""",
        "averaged_metrics": f"""SELECT {r('avg(l_quantity)')} AS l_quantity,
            {r('avg(l_tax)')} AS l_tax, 'all' AS runs FROM lineitem
            UNION ALL SELECT coalesce(avg(l_quantity), 0.0), coalesce(avg(l_tax), 0.0), 'none'
            FROM lineitem WHERE l_quantity < 0""",
        "mixture_fit_three_steps": fitted("value", "SELECT value AS x FROM events", 10, 3, 4),
        "mixture_fit": fitted("value", "SELECT value AS x FROM events", 10, 100, 3),
        "mixture_fit_large": f"""SELECT "column", k, {r('weight')} AS weight,
            {r('mean', 2)} AS mean, {r('variance', 0)} AS variance, active, rank FROM ({fitted(
                "price", "SELECT l_extendedprice AS x FROM lineitem", 10, 100, 9)})""",
        "active_components": f"""WITH w(component, weight) AS (VALUES {weight}),
            c AS (SELECT {component} AS component, count(*) AS rows FROM ({event_scored}) GROUP BY 1)
            SELECT CAST(component AS INT) AS component, coalesce(rows, 0) AS rows,
              {r('weight')} AS weight, coalesce(rows, 0) > 0 AND weight > 0.005 AS active
            FROM w LEFT JOIN c USING (component)""",
        "component_responsibilities": f"""SELECT event_id, {r('value')} AS value,
            {', '.join(f"{r(f'r{k}')} AS r{k}" for k in range(4))} FROM ({event_scored})""",
        "hard_assignment": f"""SELECT event_id, value, CAST({component} AS INT) AS component
            FROM ({event_scored})""",
        "smoothed_probabilities": f"""SELECT event_id, {r('value')} AS value,
            {', '.join(f"{r(f'(r{k} + 1e-6)/{smoothed_whole}')} AS p{k}" for k in range(3))}
            FROM ({event_scored})""",
        "mode_draw": f"SELECT event_id, z AS mode FROM ({EVENT_CODED})",
        "mode_normalised_value": f"""SELECT event_id, {r(CLIPPED)} AS normalized_value
            FROM ({EVENT_CODED})""",
        "mode_one_hot": f"""SELECT event_id,
            {', '.join(f"{hot(f'z = {i}')} AS mode_{i}" for i in range(3))} FROM ({EVENT_CODED})""",
        "encode_column": f"""SELECT event_id, {r('value')} AS value, {r(CLIPPED)} AS normalized_value,
            {', '.join(f"{hot(f'z = {i}')} AS mode_{i}" for i in range(3))} FROM ({EVENT_CODED})""",
        "decode_column": f"SELECT event_id, {r('value')} AS value, decoded FROM ({EVENT_DECODED})",
        "encode_lossless": f"""SELECT event_id, {r(CLIPPED)} AS normalized_value,
            CASE WHEN {exactly(m)} <> value THEN {r('value')} END AS overflow, {r('value')} AS decoded
            FROM ({EVENT_CODED})""",
        "encode_lossless_wide_range": """SELECT event_id, value, value AS decoded, TRUE AS same, TRUE AS raw_kept FROM (
            SELECT event_id, CASE event_id % 3 WHEN 0 THEN value*1e13::DOUBLE WHEN 1 THEN -value ELSE value/10::DOUBLE END AS value FROM events)""",
        "round_trip_exact": f"""WITH t AS (SELECT {exactly(m)} <> value AS off FROM ({EVENT_CODED}))
            SELECT FALSE AS lossless, count(*) AS rows, count(*) FILTER (WHERE off) AS inexact, CAST(0 AS BIGINT) AS kept FROM t
            UNION ALL SELECT TRUE, count(*), 0, count(*) FILTER (WHERE off) FROM t""",
        "encode_ranked": f"""SELECT event_id, {r(CLIPPED)} AS normalized_value, {order_hot},
            CASE z {ranked_place} END AS mode FROM ({EVENT_CODED})""",
        "decode_ranked": f"SELECT event_id, decoded FROM ({EVENT_DECODED})",
        "table_metadata": f"""
            SELECT 'l_quantity' AS "column", 'continuous' AS kind, min(l_quantity) AS min,
              max(l_quantity) AS max, CAST(NULL AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS modal,
              CAST(NULL AS VARCHAR) AS categories FROM lineitem
            UNION ALL SELECT 'l_extendedprice', 'continuous', min(l_extendedprice),
              max(l_extendedprice), NULL, NULL, NULL FROM lineitem
            UNION ALL SELECT 'l_discount', 'mixed', min(l_discount), max(l_discount), NULL,
              '0.0,0.1', NULL FROM lineitem
            UNION ALL SELECT 'l_returnflag', 'categorical', NULL, NULL,
              count(DISTINCT l_returnflag), NULL, {category_list(ranked('l_returnflag', 'lineitem'))}
              FROM lineitem
            UNION ALL SELECT 'l_linestatus', 'categorical', NULL, NULL,
              count(DISTINCT l_linestatus), NULL, {category_list(ranked('l_linestatus', 'lineitem'))}
              FROM lineitem""",
        "table_layout": """
            WITH b(n, "column", width, activation) AS (
              SELECT 0, 'l_quantity', 1, 'tanh' UNION ALL SELECT 1, 'l_extendedprice', 1, 'tanh'
              UNION ALL SELECT 2, 'l_discount', 1, 'tanh' UNION ALL SELECT 3, 'l_discount', 2, 'softmax'
              UNION ALL SELECT 4, 'l_returnflag', count(DISTINCT l_returnflag), 'softmax' FROM lineitem
              UNION ALL SELECT 5, 'l_linestatus', count(DISTINCT l_linestatus), 'softmax' FROM lineitem)
            SELECT "column", CAST(coalesce(sum(width) OVER (ORDER BY n ROWS BETWEEN
              UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
              CAST(width AS BIGINT) AS width, activation FROM b""",
        "min_max_normalised": f"""SELECT o_orderkey,
            {r('(o_totalprice - lo)/(hi - lo)*2.0 - 1.0')} AS scaled FROM orders,
            (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)""",
        "category_sizes": """SELECT 'event_type' AS "column", count(DISTINCT event_type) AS size
            FROM events""",
        "category_one_hot": f"""SELECT o_orderkey, o_orderpriority,
            {one_hot('rank_o_orderpriority', 5, 0)}
            FROM ({with_rank('SELECT * FROM orders', 'o_orderpriority', 'orders')})""",
        "category_one_hot_wide": f"""SELECT {LINE_KEY},
            (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS width, idx AS place,
            CAST(1 AS DOUBLE) AS ones FROM lineitem JOIN (
              SELECT l_suppkey, row_number() OVER (
                ORDER BY count(*) DESC, CAST(l_suppkey AS VARCHAR)) - 1 AS idx
              FROM lineitem GROUP BY l_suppkey) USING (l_suppkey)""",
        "category_codes_sparse": f"""SELECT c_custkey,
            {', '.join(f"{hot(f'code = {i}')} AS col_{i}" for i in (0, 2, 3, 5, 74))}, code,
            (SELECT CAST(3*max(c_nationkey) + 3 AS BIGINT) FROM customer) AS width
            FROM (SELECT c_custkey, 3*c_nationkey + 2 AS code FROM customer)""",
        "category_indexed_large": """SELECT o_orderkey, CAST(row_number() OVER (
              ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS col_0,
            CAST(o_orderkey AS VARCHAR) AS name FROM orders""",
        "category_sparse": f"""SELECT o_orderkey, o_orderstatus, (SELECT count(DISTINCT o_orderkey) FROM orders) AS width,
            k.idx AS place, CAST(1 AS INT) AS entries, CAST(1 AS DOUBLE) AS value, {one_hot('s.idx', 3, 0)}
            FROM orders JOIN ({ranked('o_orderstatus', 'orders')}) s ON s.value = o_orderstatus
            JOIN ({ranked('CAST(o_orderkey AS VARCHAR)', 'orders')}) k ON k.value = CAST(o_orderkey AS VARCHAR)""",
        "category_one_hot_table": f"""WITH m AS (SELECT {LINE_KEY}, concat(year(l_shipdate), '-', month(l_shipdate)) AS month FROM lineitem)
            SELECT {LINE_KEY}, month, month AS category, idx AS place, CAST(1 AS DOUBLE) AS ones,
              (SELECT count(DISTINCT month) FROM m) AS width
            FROM m JOIN ({ranked('month', 'm')}) d ON d.value = month""",
        "category_codes_one_hot": f"""SELECT c_custkey, {one_hot('c_nationkey', 25, 0)}
            FROM customer""",
        "category_indexed": """SELECT l_orderkey, l_linenumber, CAST(idx AS DOUBLE) AS col_0,
            lineitem.l_partkey FROM lineitem JOIN (
              SELECT l_partkey, row_number() OVER (
                ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS idx
              FROM lineitem GROUP BY l_partkey) d USING (l_partkey)""",
        "category_decode": "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer",
        "mixed_fit": table_of_fits(
            {
                "all": "SELECT l_discount AS x FROM lineitem",
                "apart": "SELECT l_discount AS x FROM lineitem WHERE l_discount <> 0.0",
            },
            4,
            100,
            5,
        ),
        "modal_normalised_values": f"""
            WITH m AS ({WHOLE_DISCOUNT}),
            p(point) AS (VALUES (0.0), (0.05), (0.1), ({MARKER})),
            near AS (SELECT CAST(point AS DOUBLE) AS point, CAST(mean AS DOUBLE) AS mean,
                CAST(variance AS DOUBLE) AS variance,
                row_number() OVER (PARTITION BY point ORDER BY abs(point - mean)) AS place FROM p, m)
            SELECT {r('point')} AS point, CASE WHEN point = {MARKER} THEN 0.0 ELSE
              {r('least(0.99, greatest(-0.99, (point - mean)/(4.0*sqrt(variance))))', 5)} END AS norm,
              (SELECT count(*) FROM lineitem WHERE l_discount = point) AS rows
            FROM near WHERE place = 1""",
        "mixed_encode": f"""SELECT event_id, {r(MIXED_NORM)} AS col_0,
            {', '.join(f"{hot(MIXED_POSITIONS[j])} AS col_{i + 1}" for i, j in enumerate(MIXED_ORDER))}
            FROM ({MIXED_CODED})""",
        "mixed_decode": f"""SELECT event_id, CASE WHEN x IS NULL THEN v
            ELSE {r(f'{CLIPPED}*width + mu')} END AS v FROM ({MIXED_CODED})""",
        "mixed_min_max": f"""SELECT {LINE_KEY},
            CASE WHEN l_discount IN (0.0, 0.1) THEN 0.0 ELSE {r(scaled('l_discount'))} END AS col_0,
            {hot('l_discount = 0.0')} AS col_1, {hot('l_discount = 0.1')} AS col_2 FROM lineitem""",
        "table_encode": f"""SELECT {LINE_KEY}, {r('pn')} AS col_0, {hot('pz = 1')} AS col_1,
            {hot('pz = 0')} AS col_2, {r('dn')} AS col_3, {hot('z = 1')} AS col_4,
            {hot('z = 0')} AS col_5, {hot('l_discount = 0.0')} AS col_6,
            {one_hot('rank_l_linestatus', 2, 7)}, {one_hot('rank_l_returnflag', 3, 9)}
            FROM ({table_ranked})""",
        "table_decode": f"""SELECT {LINE_KEY}, {r('price', 4)} AS l_extendedprice,
            {r('discount', 4)} AS l_discount, l_linestatus, l_returnflag FROM ({BOTH})""",
        "table_encode_min_max": f"""SELECT {LINE_KEY}, {r(scaled('l_quantity'))} AS col_0,
            {r(scaled('l_extendedprice'))} AS col_1,
            CASE WHEN l_discount IN (0.0, 0.1) THEN 0.0 ELSE {r(scaled('l_discount'))} END AS col_2,
            {hot('l_discount = 0.0')} AS col_3, {hot('l_discount = 0.1')} AS col_4,
            {one_hot('rank_l_returnflag', 3, 5)}, {one_hot('rank_l_linestatus', 2, 8)}
            FROM ({minmax_ranked})""",
        "table_saved": f"""SELECT {LINE_KEY}, {r(scaled('l_quantity'))} AS col_0,
            {r(scaled('l_extendedprice'))} AS col_1,
            CASE WHEN l_discount IN (0.0, 0.1) THEN 0.0 ELSE {r(scaled('l_discount'))} END AS col_2,
            {hot('l_discount = 0.0')} AS col_3, {hot('l_discount = 0.1')} AS col_4,
            {one_hot('rank_l_returnflag', 3, 5)}, {one_hot('rank_l_linestatus', 2, 8)}
            FROM ({minmax_ranked})""",
        "table_round_trip": f"""SELECT {LINE_KEY}, {r('l_extendedprice')} AS l_extendedprice,
            {r('l_discount')} AS l_discount, l_returnflag FROM lineitem""",
        "table_fit_encode": f"""WITH whole AS ({WHOLE_DISCOUNT}),
            rest AS ({fitted("d", "SELECT l_discount AS x FROM lineitem WHERE l_discount <> 0.0", 4, 100, 9)}),
            near AS (SELECT * FROM whole ORDER BY abs(mean) LIMIT 1),
            spots AS (
              SELECT -1 AS k, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS variance,
                least(0.99, greatest(-0.99, (0.0 - mean)/(4.0*sqrt(variance)))) AS norm,
                CAST((SELECT count(*) FROM lineitem WHERE l_discount = 0.0) AS DOUBLE) AS drawn FROM near
              UNION ALL SELECT k, mean, variance, NULL, frequency FROM rest WHERE active)
            SELECT CAST(k AS INT) AS k, {r('mean', 5)} AS mean, {r('variance', 5)} AS variance, {r('norm', 5)} AS norm,
              CAST(row_number() OVER (ORDER BY drawn DESC, k) - 1 AS INT) AS place FROM spots""",
        "table_lossless_min_max": f"""SELECT {LINE_KEY},
            CASE WHEN NOT l_quantity BETWEEN lo AND hi
              OR (((l_quantity - lo)/(hi - lo)*2.0::DOUBLE - 1.0::DOUBLE) + 1.0::DOUBLE)/2.0::DOUBLE*(hi - lo) + lo <> l_quantity
              THEN l_quantity END AS overflow_l_quantity,
            {r('l_quantity')} AS l_quantity, CAST(trunc(l_extendedprice*100) AS BIGINT)*1000003*10007 AS big
            FROM lineitem, (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem WHERE l_quantity <= 10)""",
        "generated_data": f"SELECT event_id, copy, {r('value')} AS value FROM ({inflated(25_000)})",
        "distribution_test": tested(
            f"""SELECT value AS x, 1 AS a, 0 AS b FROM events
            UNION ALL SELECT decoded, 0, 1 FROM ({EVENT_DECODED})"""
        ),
        "distribution_test_unequal": tested(
            """SELECT value AS x, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS a,
            CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS b FROM events"""
        ),
        "distribution_test_exact": f"""WITH RECURSIVE series AS (FROM ({tested("""SELECT s_acctbal AS x, 1 AS a, 0 AS b FROM supplier
              UNION ALL SELECT c_acctbal, 0, 1 FROM customer""")})),
            test AS (FROM ({ks("""SELECT s_acctbal AS x, 1 AS a, 0 AS b FROM supplier
              UNION ALL SELECT c_acctbal, 0, 1 FROM customer""")})),
            size AS (SELECT CAST(n AS BIGINT) AS n, CAST(m AS BIGINT) AS m, CAST(m AS BIGINT)//gcd(n, m) AS right_by, CAST(n AS BIGINT)//gcd(n, m) AS up_by,
              CAST(round(statistic*n*m/gcd(n, m)) AS BIGINT) AS most, greatest(n, m) <= 10000 AS exact FROM test),
            walk AS (SELECT CAST(0 AS BIGINT) AS s, list_transform(range(0, n + 1), lambda i: 0.0::DOUBLE) AS v FROM size
              UNION ALL SELECT s + 1, list_transform(range(0, n + 1), lambda i:
                CASE WHEN s + 1 - i < 0 OR s + 1 - i > m THEN 0.0::DOUBLE WHEN abs(i*right_by - (s + 1 - i)*up_by) >= most THEN 1.0::DOUBLE
                ELSE ((CASE WHEN i > 0 THEN v[i] ELSE 0.0::DOUBLE END)*i + v[i + 1]*(s + 1 - i))/(s + 1) END)
              FROM walk, size WHERE s < n + m AND exact),
            last AS (SELECT v[len(v)] AS p FROM walk, size WHERE s = n + m)
            SELECT {r('statistic')} AS statistic, {r('coalesce((SELECT p FROM last), p_value)')} AS p_value,
              coalesce((SELECT p FROM last), p_value) > 0.05 AS valid, n, m FROM series""",
        "bounds_test": f"""SELECT bool_and(value BETWEEN lo AND hi) AS valid,
            count(*) FILTER (WHERE NOT value BETWEEN lo AND hi) AS violations
            FROM ({inflated(20_000)}), (SELECT min(value) AS lo, max(value) AS hi FROM events)""",
        "moments_test": f"""SELECT {MOMENTS_VALID} AS valid, {r('mean', 4)} AS mean,
            {r('std', 4)} AS std, {r('skew', 4)} AS skew, {r('kurtosis', 4)} AS kurtosis
            FROM (SELECT {MOMENT_GAPS} FROM ({EVENT_DECODED}))""",
        "combined_accuracy": f"""
            WITH decoded_events AS ({EVENT_DECODED}),
            checks AS (SELECT {BOUNDS_VALID} AS bounds_valid, {MOMENTS_VALID} AS moments_valid
              FROM (SELECT {MOMENT_GAPS} FROM decoded_events)),
            verdict AS ({tested('''SELECT value AS x, 1 AS a, 0 AS b FROM decoded_events
              UNION ALL SELECT decoded, 0, 1 FROM decoded_events''')})
            SELECT valid AS distribution_valid, p_value, bounds_valid, moments_valid,
              {r('''(CAST(bounds_valid AS INT) + CAST(moments_valid AS INT) + CAST(valid AS INT))/3.0''')}
              AS accuracy FROM checks, verdict""",
        "round_trip_check": f"""SELECT count(*) AS rows,
            count(*) FILTER (WHERE NOT decoded BETWEEN lo - 1e-6*sd AND hi + 1e-6*sd) AS outside,
            count(*) FILTER (WHERE abs(value - decoded) > 1e-6*sd) AS damaged,
            {r('max(abs(value - decoded))', 4)} AS max_error FROM ({EVENT_DECODED}),
            (SELECT min(value) AS lo, max(value) AS hi, stddev_pop(value) AS sd FROM events)""",
        "round_trip_not_finite": f"""SELECT count(*) AS rows, count({FINITE}) AS finite_in,
            count({FINITE}) AS finite_out, count(*) FILTER (WHERE NOT isfinite(value)) AS not_finite,
            {r(f'min({FINITE})')} AS low, {r(f'max({FINITE})')} AS high, CAST(0 AS BIGINT) AS damaged FROM {WITH_GAPS}""",
        "generated_not_finite": f"""SELECT event_id, copy,
            {r(f"""{FINITE} + ({uniform('jitter', 'event_id', 'copy')} - 0.5)*(SELECT stddev_samp({FINITE}) FROM {WITH_GAPS})*0.1""")} AS value,
            coalesce(isnan(value), FALSE) AS nan
            FROM (SELECT g.event_id, g.value, copy FROM {WITH_GAPS} g,
              range((SELECT CAST(greatest(1, ceil(25000/count(*))) AS BIGINT) FROM events)) AS t(copy))""",
        "error_by_decile": f"""
            WITH edges AS (SELECT quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])
              AS e FROM events)
            SELECT CAST(1 + len(list_filter(e, lambda v: v < value)) AS INT) AS decile, count(*) AS rows,
              {r('max(abs(value - decoded))', 4)} AS max_error
            FROM ({EVENT_DECODED}), edges GROUP BY 1""",
        "generation_run": f"""SELECT 'value' AS "column", count(*) AS count,
            {r('avg(value)', 4)} AS mean, {r('stddev_samp(value)', 4)} AS stddev,
            {r('min(value)', 4)} AS min, {r('max(value)', 4)} AS max, count(*) AS rows,
            TRUE AS complete FROM ({inflated(50_000)})""",
        "encode_run_values": f"""SELECT event_id, {r('value')} AS value, {r('value')} AS decoded,
            CAST(1 AS INT) AS modes, TRUE AS inside FROM events""",
        "encode_run_modes": f"""WITH RECURSIVE {fit("SELECT value AS x FROM events", 10, 100)},
            spots AS (SELECT k, c, mean, variance, centre0 + scale*mean AS mu, scale*sqrt(variance) AS sd, active FROM posterior JOIN wins USING (k), measures),
            logs AS (SELECT event_id, value, s.*, c - 0.5*pow((value - mu)/sd, 2) AS l FROM events, spots s),
            parts AS (SELECT *, exp(l - max(l) OVER (PARTITION BY event_id)) AS e FROM logs),
            chances AS (SELECT *, e/sum(e) OVER (PARTITION BY event_id) + 1e-6 AS q FROM parts),
            sums AS (SELECT *, dense_rank() OVER (ORDER BY k) - 1 AS mode, sum(q) OVER (PARTITION BY event_id ORDER BY k ROWS UNBOUNDED PRECEDING)
              /sum(q) OVER (PARTITION BY event_id) AS upto FROM chances WHERE active),
            placed AS (SELECT mode, value, (value - mu)/(4.0*sd) AS n FROM sums WHERE {uniform('mode:value', 'event_id')} < upto
              QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY k) = 1)
            SELECT CAST(mode AS INT) AS mode, count(*) AS rows, {r(f'avg({CLIPPED})', 3)} AS mean, {r(f'stddev_samp({CLIPPED})', 3)} AS spread,
              count(*) FILTER (WHERE abs(n) >= 0.99) AS clipped, {r('min(value)', 3)} AS low, {r('max(value)', 3)} AS high FROM placed GROUP BY 1""",
        "encode_run": f"""SELECT count(*) AS rows, count(*) AS rows_read_back,
            {r('min(value)')} AS low, {r('max(value)')} AS high, CAST(0 AS BIGINT) AS outside,
            CAST(0 AS BIGINT) AS damaged, CAST(1 AS DOUBLE) AS accuracy,
            TRUE AS measured FROM events""",
        "table_file_stream": f"""SELECT l_orderkey, l_linenumber, {r(scaled('l_quantity'))} AS col_0, CAST(p.idx AS DOUBLE) AS col_1,
            {one_hot('f.idx', 3, 2)}, l_quantity, l_partkey, l_suppkey, l_returnflag
            FROM lineitem JOIN ({ranked('l_returnflag', 'lineitem')}) f ON f.value = l_returnflag
            JOIN ({ranked('CAST(l_partkey AS VARCHAR)', 'lineitem')}) p ON p.value = CAST(l_partkey AS VARCHAR)""",
        "encode_file_stream": f"""SELECT event_id, {r('value')} AS value,
            {r(CLIPPED)} AS normalized_value,
            {', '.join(f"{hot(f'z = {i}')} AS mode_{i}" for i in range(3))} FROM ({EVENT_CODED})""",
    }
