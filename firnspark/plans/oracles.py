"""Independent SQL for the registered queries, over the plain test tables.

Every statement starts from the tables; shared steps are common table expressions put
together by ``with_steps``.
"""

from __future__ import annotations

import re

from firnspark.functions.aspects import ASPECTS, COMPONENT_COLUMNS, COMPONENTS, ELEVATIONS, SLOTS
from firnspark.functions.codes import NWAC_AREA_IDS
from firnspark.plans import standin
from firnspark.schema import BULLETIN

STEPS: dict[str, str] = {}


def with_steps(names: str, body: str) -> str:
    """A statement with the named steps and everything they build on."""
    wanted: list[str] = []

    def add(name: str) -> None:
        if name in wanted:
            return
        for needed in NEEDS.get(name, "").split():
            add(needed)
        wanted.append(name)

    for name in names.split():
        add(name)
    recursive = "RECURSIVE " if any(name.startswith("inverse") for name in wanted) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({STEPS[n]})" for n in wanted) + "\n" + body


NEEDS = {
    "bulletin": "slots",
    "combined": "bulletin",
    "winners": "combined",
    "frame": "components",
    "spans": "",
    "cells": "frame spans",
    "majority": "cells",
    "scoring_rows": "components spans",
    "resolved": "scoring_rows majority",
    "chained": "resolved",
    "x_rows": "frame",
    "sums": "x_rows spans",
    "inverse": "sums",
    "refined": "inverse",
    "weights": "refined",
    "test_confusion": "frame majority spans",
    "caic_days": "bulletin",
    "caic": "caic_days",
    "nwac_rows": "bulletin",
    "nwac": "nwac_rows",
}


# --- scalar helpers -----------------------------------------------------------------


def season_sql(day: str, upcoming: bool = False) -> str:
    summer = f"year({day}) || '/' || (year({day}) + 1)" if upcoming else "'OFF_SEASON'"
    return (
        f"CASE WHEN month({day}) >= 9 THEN year({day}) || '/' || (year({day}) + 1) "
        f"WHEN month({day}) < 6 THEN (year({day}) - 1) || '/' || year({day}) ELSE {summer} END"
    )


def season_year_sql(day: str) -> str:
    return f"(CAST(year({day}) AS INTEGER) - CASE WHEN month({day}) < 9 THEN 1 ELSE 0 END)"


def in_season_sql(day: str) -> str:
    return f"(month({day}) >= 9 OR month({day}) < 6)"


def day_number_sql(day: str) -> str:
    start = f"make_date({season_year_sql(day)}, 9, 1)"
    return f"CASE WHEN {in_season_sql(day)} THEN CAST({day} - {start} AS BIGINT) ELSE -1 END"


def pick_sql(names: list[str], index: str) -> str:
    return "(CASE " + index + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END)"


def code_sql(table: dict[str, int], name: str, default: str = "NULL") -> str:
    return f"(CASE {name} " + " ".join(f"WHEN '{n}' THEN {c}" for n, c in table.items()) + f" ELSE {default} END)"


def plain_columns(names: list[str], dates: set[str], stamps: set[str], alias: str = "") -> str:
    """Dates as text and timestamps as milliseconds, as the queries give them."""
    out = []
    for name in names:
        source = f"{alias}.{name}" if alias else name
        if name in dates:
            out.append(f"CAST({source} AS VARCHAR) AS {name}")
        elif name in stamps:
            out.append(f"epoch_ms({source}) AS {name}")
        else:
            out.append(f"{source} AS {name}")
    return ", ".join(out)


DATES = {"distribution_date", "forecast_date", "analysis_date", "landed_date"}
STAMPS = {"publish_datetime", "analysis_datetime", "creation_datetime"}


def bulletin_columns(alias: str = "", names: list[str] | None = None) -> str:
    return plain_columns(names or BULLETIN.names, DATES, STAMPS, alias)


# --- the combined view ----------------------------------------------------------------

_LINE_VALUES = {
    "type": "l_partkey % 10",
    "alp": "(l_suppkey * 37 + l_partkey) % 256",
    "tln": "(l_suppkey * 53 + l_partkey * 3) % 256",
    "btl": "(l_partkey * 11 + l_orderkey) % 256",
    "likelihood": "1 + l_partkey % 5",
    "quantity": "l_quantity",
}
STEPS["slots"] = (
    "SELECT l_orderkey, "
    + ", ".join(
        f"max(CASE WHEN l_linenumber = {s + 1} THEN {value} END) AS {name}_{s}"
        for s in standin.LINES
        for name, value in _LINE_VALUES.items()
    )
    + " FROM lineitem GROUP BY l_orderkey"
)
STEPS["bulletin"] = (
    "SELECT o.*, n.n_regionkey, CAST(n.n_regionkey AS VARCHAR) AS rk, o.o_orderkey AS k, o.o_orderdate AS t0, "
    "CAST(o.o_orderdate AS DATE) AS d, s.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey "
    "JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN slots s ON s.l_orderkey = o.o_orderkey"
)


def _combined_values() -> dict[str, str]:
    published = "(t0 + to_seconds(k % 86400))"
    values = {
        "publish_datetime": published,
        "region_id": "'C' || (n_regionkey % 2) || '.' || rk",
        "forecast_center": "'C' || (n_regionkey % 2)",
        "analysis_datetime": f"({published} + to_seconds(k // 86400))",
        "distribution_date": "CAST(d - CAST(k % 3 AS INTEGER) AS DATE)",
        "forecast_date": "d",
        "forecast_days_out": "k % 3",
        "forecast_date_season_day_number": day_number_sql("d"),
        "avalanche_season": season_sql("d"),
        "area_name": "CASE WHEN k % 11 <> 0 THEN 'Zone ' || rk ELSE 'undefined' END",
        "area_id": "rk",
        "polygons": "'p' || rk",
        "avalanche_summary": "o_orderpriority",
        "danger_alp": "k % 6",
        "danger_tln": "(k // 6) % 6",
        "danger_btl": "(k // 36) % 6",
    }
    for s in SLOTS:
        values[f"problem_type_{s}"] = f"coalesce(type_{s}, 0)"
        values[f"likelihood_{s}"] = f"coalesce(likelihood_{s}, 0)"
        values[f"min_size_{s}"] = f"coalesce(quantity_{s} / 10, 0.0::DOUBLE)"
        values[f"max_size_{s}"] = f"coalesce(quantity_{s} / 5, 0.0::DOUBLE)"
        for e in ELEVATIONS:
            for i, a in enumerate(ASPECTS):
                values[f"{a}_{e}_{s}"] = f"(coalesce({e}_{s}, 0) >> {i}) & 1"
            values[f"{e}_prevalence_{s}"] = f"CAST(bit_count(coalesce({e}_{s}, 0)) AS BIGINT)"
        values[f"prevalence_{s}"] = "CAST(" + " + ".join(f"bit_count(coalesce({e}_{s}, 0))" for e in ELEVATIONS) + " AS BIGINT)"
    return values


STEPS["combined"] = (
    "SELECT " + ", ".join(f"{value} AS {name}" for name, value in _combined_values().items()) + " FROM bulletin"
)
STEPS["winners"] = (
    "SELECT * FROM combined WHERE forecast_days_out = 0 AND avalanche_season <> 'OFF_SEASON' "
    "QUALIFY row_number() OVER (PARTITION BY region_id, forecast_date "
    "ORDER BY publish_datetime DESC, analysis_datetime DESC) = 1"
)

# Longest circular run of set bits of each of the 256 masks, found among all arcs.
STEPS["geometry"] = """
    SELECT m.range AS m,
      CASE WHEN s IS NULL THEN 0.0::DOUBLE ELSE round(sin((s + (l - 1) / 2.0) * pi() / 4), 12) + 0.0 END AS g_sin,
      CASE WHEN s IS NULL THEN 0.0::DOUBLE ELSE round(cos((s + (l - 1) / 2.0) * pi() / 4), 12) + 0.0 END AS g_cos,
      CASE WHEN m.range = 255 THEN 1.0::DOUBLE ELSE coalesce(l, 0) / 8.0::DOUBLE END AS g_range
    FROM range(256) m LEFT JOIN (
      SELECT v.range AS v, s.range AS s, l.range AS l
      FROM range(256) v, range(8) s, range(1, 8) l
      WHERE (((v.range + v.range * 256 + v.range * 65536) >> s.range) & ((1 << l.range) - 1)) = (1 << l.range) - 1
        AND (((v.range + v.range * 256) >> (s.range + 7)) & 1) = 0
        AND (((v.range + v.range * 256 + v.range * 65536) >> (s.range + l.range)) & 1) = 0
      QUALIFY row_number() OVER (
        PARTITION BY v.range ORDER BY l.range DESC, CASE WHEN s.range + l.range > 8 THEN 0 ELSE s.range END) = 1
    ) arcs ON arcs.v = m.range"""



def component_steps(source: str, masked: str, components: str) -> None:
    """Steps that add the masks and the 27 components to the rows of another step."""
    masks = ", ".join(
        "(" + " + ".join(f"{a}_{e}_{s} * {1 << i}" for i, a in enumerate(ASPECTS)) + f") AS m_{e}_{s}"
        for s in SLOTS
        for e in ELEVATIONS
    )
    STEPS[masked] = f"SELECT *, {masks} FROM {source}"
    values = ", ".join(
        f"g_{e}_{s}.g_{c} AS aspect_{c}_{e}_{s}" for s in SLOTS for e in ELEVATIONS for c in COMPONENTS
    )
    joins = " ".join(f"JOIN geometry g_{e}_{s} ON g_{e}_{s}.m = m_{e}_{s}" for s in SLOTS for e in ELEVATIONS)
    STEPS[components] = f"SELECT r.*, {values} FROM {masked} r {joins}"
    NEEDS[masked] = source
    NEEDS[components] = f"{masked} geometry"


component_steps("winners", "masked", "components")

MODEL_COLUMNS = [f"problem_type_{s}" for s in SLOTS] + COMPONENT_COLUMNS
STEPS["frame"] = (
    f"SELECT t.region_id, t.forecast_date, {season_year_sql('t.forecast_date')} AS season_year, "
    + ", ".join(f"f.{c} AS {c}, t.{c} AS target_{c}" for c in MODEL_COLUMNS)
    + " FROM components t JOIN components f ON f.region_id = t.region_id AND f.forecast_date + 1 = t.forecast_date"
)

# First and last model season: those of the first and last order day.
STEPS["spans"] = (
    "SELECT CAST(range AS INTEGER) AS model_year FROM ("
    "SELECT year(min(o_orderdate)) - CASE WHEN month(min(o_orderdate)) < 6 THEN 1 ELSE 0 END AS lo, "
    "year(max(o_orderdate)) - CASE WHEN month(max(o_orderdate)) < 6 THEN 1 ELSE 0 END AS hi FROM orders) b, "
    "range(b.lo, b.hi + 1)"
)

# --- majority models --------------------------------------------------------------------

_LEVEL_KEYS = {1: ("k0", "-1", "-1"), 2: ("k0", "k1", "-1"), 3: ("k0", "k1", "k2")}
_CELL_PARTS = [
    f"SELECT region_id, season_year, {slot} AS slot, {level} AS level, "
    + ", ".join(
        f"CAST({key.replace('k', 'problem_type_')} AS BIGINT) AS k{i}" for i, key in enumerate(_LEVEL_KEYS[level])
    )
    + f", target_problem_type_{slot} AS y FROM frame"
    for slot in SLOTS
    for level in ((1,) if slot == 0 else (1, 2, 3))
]
STEPS["cells"] = (
    "SELECT region_id, model_year, slot, level, k0, k1, k2, y, count(*) AS n FROM ("
    + " UNION ALL ".join(_CELL_PARTS)
    + ") JOIN spans ON model_year >= season_year + 2 GROUP BY ALL"
)
STEPS["majority"] = (
    "SELECT region_id, model_year, slot, level, k0, k1, k2, list(y ORDER BY n DESC, y ASC) AS ranked, "
    "CAST(sum(n) AS BIGINT) AS n_rows FROM cells GROUP BY ALL"
)
# Trees of up to ``TREE_DEPTH`` splits: per level the cells, the best splits and the nodes.
TREE_DEPTH = 4
_NODE = "region_id, model_year, slot, node"
STEPS["tree_cells_0"] = (
    "SELECT region_id, model_year, slot, CAST(1 AS BIGINT) AS node, k0, k1, k2, y, n FROM cells "
    "WHERE level = CASE WHEN slot = 0 THEN 1 ELSE 3 END"
)
NEEDS["tree_cells_0"] = "cells"


def tree_level(depth: int) -> None:
    cells, values, best = f"tree_cells_{depth}", f"tree_values_{depth}", f"tree_best_{depth}"
    STEPS[values] = f"SELECT {_NODE}, feature, v, y, CAST(sum(n) AS DOUBLE) AS n FROM (" + " UNION ALL ".join(
        f"SELECT {_NODE}, {i} AS feature, k{i} AS v, y, n FROM {cells}" for i in range(3)
    ) + ") GROUP BY ALL"
    STEPS[best] = f"""
        SELECT {_NODE}, feature, threshold FROM (
            SELECT {_NODE}, feature, threshold,
                sum(below * below) / sum(below) + sum(above * above) / sum(above) AS purity
            FROM (
                SELECT {", ".join(f"v.{c}" for c in _NODE.split(", "))}, v.feature, c.threshold, v.y,
                    sum(CASE WHEN v.v < c.threshold THEN v.n ELSE 0 END) AS below,
                    sum(CASE WHEN v.v > c.threshold THEN v.n ELSE 0 END) AS above
                FROM {values} v JOIN (
                    SELECT {_NODE}, feature, (v + lead(v) OVER (PARTITION BY {_NODE}, feature ORDER BY v)) / 2.0 AS threshold
                    FROM (SELECT DISTINCT {_NODE}, feature, v FROM {values})
                ) c USING ({_NODE}, feature)
                WHERE c.threshold IS NOT NULL GROUP BY ALL
            ) GROUP BY ALL HAVING count(*) > 1
        ) QUALIFY row_number() OVER (PARTITION BY {_NODE} ORDER BY purity DESC, feature, threshold) = 1"""
    STEPS[f"tree_cells_{depth + 1}"] = (
        f"SELECT region_id, model_year, slot, 2 * node + CAST([k0, k1, k2][feature + 1] > threshold AS BIGINT) AS node, "
        f"k0, k1, k2, y, n FROM {cells} JOIN {best} USING ({_NODE})"
    )
    NEEDS[values], NEEDS[best], NEEDS[f"tree_cells_{depth + 1}"] = cells, values, best


def tree_nodes(depth: int, last: bool) -> str:
    split = "CAST(NULL AS INTEGER) AS feature, CAST(NULL AS DOUBLE) AS threshold" if last else "feature, threshold"
    join = "" if last else f"LEFT JOIN tree_best_{depth} USING ({_NODE})"
    return f"""SELECT {_NODE}, {split}, ranked, n_rows FROM (
        SELECT {_NODE}, list(y ORDER BY n DESC, y) AS ranked, CAST(sum(n) AS BIGINT) AS n_rows FROM (
            SELECT {_NODE}, y, sum(n) AS n FROM tree_cells_{depth} GROUP BY ALL) GROUP BY ALL) {join}"""


for _depth in range(TREE_DEPTH):
    tree_level(_depth)
STEPS["trees"] = " UNION ALL ".join(tree_nodes(depth, depth == TREE_DEPTH) for depth in range(TREE_DEPTH + 1))
NEEDS["trees"] = " ".join(f"tree_best_{depth}" for depth in range(TREE_DEPTH)) + f" tree_cells_{TREE_DEPTH}"

# Feature rows of in-season days: yesterday's winners under today's date.
STEPS["scoring_rows"] = (
    f"SELECT region_id, CAST(forecast_date + 1 AS DATE) AS forecast_date, "
    f"{season_year_sql('(forecast_date + 1)')} AS model_year, "
    + ", ".join(MODEL_COLUMNS)
    + f" FROM components WHERE {in_season_sql('(forecast_date + 1)')}"
)


def _resolve(rows: str, columns: str) -> str:
    """Ranked classes by the longest seen prefix of the codes, else the nearest first code."""
    ranked = ", ".join(
        f"coalesce(a{s}.ranked, b{s}.ranked, c{s}.ranked) AS ranked_{s}" for s in (1, 2)
    )
    joins = ""
    for s in (1, 2):
        group = "{0}.region_id = r.region_id AND {0}.model_year = r.model_year AND {0}.slot = " + str(s)
        joins += f" LEFT JOIN majority a{s} ON {group.format(f'a{s}')} AND a{s}.level = 3 AND a{s}.k0 = r.problem_type_0 AND a{s}.k1 = r.problem_type_1 AND a{s}.k2 = r.problem_type_2"
        joins += f" LEFT JOIN majority b{s} ON {group.format(f'b{s}')} AND b{s}.level = 2 AND b{s}.k0 = r.problem_type_0 AND b{s}.k1 = r.problem_type_1"
        joins += f" JOIN majority c{s} ON {group.format(f'c{s}')} AND c{s}.level = 1 AND c{s}.k0 = near.code"
    return (
        f"SELECT {columns}, z.ranked AS ranked_0, {ranked} FROM {rows} r "
        "JOIN (SELECT q.region_id, q.model_year, q.problem_type_0, m.k0 AS code FROM "
        f"(SELECT DISTINCT region_id, model_year, problem_type_0 FROM {rows}) q "
        "JOIN majority m ON m.region_id = q.region_id AND m.model_year = q.model_year AND m.slot = 0 "
        "QUALIFY row_number() OVER (PARTITION BY q.region_id, q.model_year, q.problem_type_0 "
        "ORDER BY abs(m.k0 - q.problem_type_0), m.k0) = 1) near "
        "ON near.region_id = r.region_id AND near.model_year = r.model_year AND near.problem_type_0 = r.problem_type_0 "
        "JOIN majority z ON z.region_id = r.region_id AND z.model_year = r.model_year AND z.slot = 0 AND z.k0 = near.code"
        + joins
    )


STEPS["resolved"] = _resolve("scoring_rows", "r.*")
STEPS["chained"] = (
    "SELECT *, CASE WHEN p0 = 0 OR p1 = 0 THEN 0 "
    "ELSE coalesce(list_filter(ranked_2, lambda x: x <> p0 AND x <> p1)[1], 0) END AS p2 FROM ("
    "SELECT *, CASE WHEN p0 = 0 THEN 0 ELSE coalesce(list_filter(ranked_1, lambda x: x <> p0)[1], 0) END AS p1 FROM ("
    "SELECT *, ranked_0[1] AS p0 FROM resolved))"
)
STEPS["test_confusion"] = (
    "SELECT 'problem_type_' || slot AS model_name, region_id, model_year, y_true, y_pred, count(*) AS n FROM ("
    + " UNION ALL ".join(
        f"SELECT {s} AS slot, region_id, model_year, target_problem_type_{s} AS y_true, ranked_{s}[1] AS y_pred "
        "FROM test_resolved"
        for s in SLOTS
    )
    + ") GROUP BY ALL"
)
STEPS["test_frame"] = (
    "SELECT frame.*, season_year + 1 AS model_year FROM frame WHERE season_year + 1 IN (SELECT model_year FROM spans)"
)
STEPS["test_resolved"] = _resolve("test_frame", "r.*")
NEEDS["test_frame"] = "frame spans"
NEEDS["test_resolved"] = "test_frame majority"
NEEDS["test_confusion"] = "test_resolved"

# --- least squares ------------------------------------------------------------------------

SLOT_COMPONENTS = [f"aspect_{c}_{e}" for e in ELEVATIONS for c in COMPONENTS]


def matched_sql(problem: str, slot_alias: str = "") -> list[str]:
    """Inputs of an aspect model: the type and the components of the first slot of this type."""
    values = [f"CAST({problem} AS DOUBLE)"]
    for name in SLOT_COMPONENTS:
        arms = " ".join(f"WHEN problem_type_{s} = {problem} THEN {name}_{s}" for s in SLOTS)
        values.append(f"CASE {arms} ELSE 0.0::DOUBLE END")
    return values


STEPS["x_rows"] = " UNION ALL ".join(
    f"SELECT region_id, season_year, {s} AS slot, [{', '.join(matched_sql(f'target_problem_type_{s}'))}] AS x, "
    f"[{', '.join(f'target_{name}_{s}' for name in SLOT_COMPONENTS)}] AS y FROM frame"
    for s in SLOTS
)


def _square(entry: str, rows: int, cols: int) -> str:
    return "[" + ", ".join("[" + ", ".join(entry.format(i=i + 1, j=j + 1) for j in range(cols)) + "]" for i in range(rows)) + "]"


STEPS["sums"] = f"""
    SELECT *, (SELECT max(v) FROM (SELECT unnest([{', '.join(f'a[{i}][{i}]' for i in range(1, 11))}]) AS v)) AS scale FROM (
      SELECT region_id, model_year, slot, count(*) AS n,
        [{', '.join(f'avg(x[{i}])' for i in range(1, 11))}] AS mx,
        [{', '.join(f'avg(y[{j}])' for j in range(1, 10))}] AS my,
        {_square('covar_pop(x[{i}], x[{j}]) * count(*)', 10, 10)} AS a,
        {_square('covar_pop(x[{i}], y[{j}]) * count(*)', 10, 9)} AS b
      FROM x_rows JOIN spans ON model_year >= season_year + 2 GROUP BY ALL)"""
# Inverse of A + eI by Gauss-Jordan elimination, one pivot a step.
STEPS["inverse"] = f"""
    SELECT region_id, model_year, slot, 1 AS p, list_transform(range(1, 11), lambda i: list_transform(range(1, 21),
        lambda j: CASE WHEN j > 10 THEN (CASE WHEN j - 10 = i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
             WHEN i = j THEN a[i][j] + 1e-9 * greatest(scale, 1e-9) ELSE a[i][j] END)) AS m FROM sums
    UNION ALL
    SELECT region_id, model_year, slot, p + 1, list_transform(range(1, 11), lambda i: list_transform(range(1, 21),
        lambda j: CASE WHEN i = p THEN m[p][j] / m[p][p] ELSE m[i][j] - m[i][p] * m[p][j] / m[p][p] END)) FROM inverse WHERE p <= 10"""
# Repeated correction leads to the minimum-norm solution w of A w = b (steps 1 to 12).  What rounding
# left outside the range of A is then singled out in v, where e (A + eI)^-1 keeps only that, and taken off.
STEPS["refined"] = """
    SELECT s.region_id, s.model_year, s.slot, 1 AS step, 1e-9 * greatest(scale, 1e-9) AS eps,
        list_transform(range(1, 11), lambda i: list_transform(range(11, 21), lambda j: m[i][j])) AS g,
        a, b, list_transform(range(1, 11), lambda i: list_transform(range(1, 10), lambda j: 0.0::DOUBLE)) AS w,
        list_transform(range(1, 11), lambda i: list_transform(range(1, 10), lambda j: 0.0::DOUBLE)) AS v
    FROM sums s JOIN inverse v ON v.region_id = s.region_id AND v.model_year = s.model_year AND v.slot = s.slot AND v.p = 11
    UNION ALL
    SELECT region_id, model_year, slot, step + 1, eps, g, a, b,
        CASE WHEN step > 12 THEN w ELSE list_transform(range(1, 11), lambda i: list_transform(range(1, 10), lambda j: w[i][j] + list_dot_product(g[i], list_transform(range(1, 11),
            lambda q: b[q][j] - list_dot_product(a[q], list_transform(range(1, 11), lambda u: w[u][j])))))) END,
        CASE WHEN step <= 13 THEN w ELSE list_transform(range(1, 11), lambda i: list_transform(range(1, 10), lambda j: eps * list_dot_product(g[i],
            list_transform(range(1, 11), lambda u: v[u][j])))) END
    FROM refined WHERE step <= 25"""
STEPS["weights"] = """
    SELECT region_id, model_year, slot, n, w, list_transform(range(1, 10), lambda j: my[j] - list_dot_product(mx,
        list_transform(range(1, 11), lambda i: w[i][j]))) AS w0
    FROM (SELECT s.*, list_transform(range(1, 11), lambda i: list_transform(range(1, 10), lambda j: r.w[i][j] - r.v[i][j])) AS w
        FROM refined r JOIN sums s ON s.region_id = r.region_id AND s.model_year = r.model_year AND s.slot = r.slot
        WHERE r.step = 26)"""

# The same for the earlier release, whose inputs are those of the model's own slot.
for _name in ("sums", "inverse", "refined", "weights"):
    STEPS[f"{_name}_own"] = re.sub(r"\b(x_rows|sums|inverse|refined)\b", r"\1_own", STEPS[_name])
STEPS["x_rows_own"] = " UNION ALL ".join(
    f"SELECT region_id, season_year, {s} AS slot, [CAST(problem_type_{s} AS DOUBLE), {', '.join(f'{n}_{s}' for n in SLOT_COMPONENTS)}] AS x, "
    f"[{', '.join(f'target_{name}_{s}' for name in SLOT_COMPONENTS)}] AS y FROM frame"
    for s in SLOTS
)
NEEDS |= {
    "x_rows_own": "frame",
    "sums_own": "x_rows_own spans",
    "inverse_own": "sums_own",
    "refined_own": "inverse_own",
    "weights_own": "refined_own",
}

# --- normalised bulletins -------------------------------------------------------------------

_RISK_BY_INDEX = "(CASE WHEN {0} % 8 < 6 THEN {0} % 8 ELSE 0 END)"


def _bits(slot: int, chosen: dict[str, str]) -> dict[str, str]:
    return {f"{a}_{e}_{slot}": f"({chosen[e]} >> {i}) & 1" for e in ELEVATIONS for i, a in enumerate(ASPECTS)}


def _caic_values() -> dict[str, str]:
    day = "CAST(d + CAST(day AS INTEGER) AS DATE)"
    issued = "(t0 + to_minutes(30 * (k % 48)) + to_seconds((k // 48) % 1800) + to_milliseconds(250 * (k % 2)))"
    instant = f"(timezone('America/Denver', {issued}) AT TIME ZONE 'UTC')"
    values = {
        "publish_datetime": instant,
        "region_id": "'CAIC.' || rk",
        "forecast_center": "'CAIC'",
        "analysis_datetime": instant,
        "distribution_date": "d",
        "forecast_date": day,
        "forecast_days_out": "day",
        "forecast_date_season_day_number": day_number_sql(day),
        "avalanche_season": season_sql(day),
        "area_name": "CASE WHEN k % 4 <> 0 THEN 'Zone ' || rk ELSE 'undefined' END",
        "area_id": "rk",
        "polygons": "'p' || rk || ',q' || (k % 3)",
        "avalanche_summary": "CASE WHEN day = 0 THEN 'S' || k WHEN day = 1 AND k % 2 = 1 THEN 'T' || k ELSE '' END",
    }
    for elevation, index in (("alp", "(k + day)"), ("tln", "(k // 2 + day)"), ("btl", "(k // 3 + day)")):
        values[f"danger_{elevation}"] = f"CASE WHEN day < k % 4 THEN {_RISK_BY_INDEX.format(index)} ELSE 0 END"
    for s in SLOTS:
        present = f"(day < (k // 4) % 3 AND coalesce(type_{s}, 0) <> 0" + (" AND day = 0)" if s == 0 else ")")
        masks = {e: f"(CASE WHEN {present} THEN {e}_{s} ELSE 0 END)" for e in ELEVATIONS}
        extra = f"(CASE WHEN {present} AND k % 5 = 0 THEN 1 ELSE 0 END)"
        values[f"problem_type_{s}"] = f"CASE WHEN {present} THEN type_{s} ELSE 0 END"
        values[f"likelihood_{s}"] = f"CASE WHEN {present} THEN likelihood_{s} ELSE 0 END"
        values[f"min_size_{s}"] = f"CASE WHEN {present} THEN quantity_{s} / 10 ELSE 0.0::DOUBLE END"
        values[f"max_size_{s}"] = f"CASE WHEN {present} THEN quantity_{s} / 5 ELSE 0.0::DOUBLE END"
        values |= _bits(s, masks)
        for e in ELEVATIONS:
            more = f" + {extra}" if e == "alp" else ""
            values[f"{e}_prevalence_{s}"] = f"CAST(bit_count({masks[e]}){more} AS BIGINT)"
        total = " + ".join(f"bit_count({masks[e]})" for e in ELEVATIONS)
        values[f"prevalence_{s}"] = f"CAST({total} + {extra} AS BIGINT)"
    return values


STEPS["caic_days"] = (
    "SELECT *, unnest(range(0, greatest(k % 4, (k // 4) % 3))) AS day FROM bulletin WHERE k % 10 <> 9"
)
STEPS["caic"] = "SELECT k, " + ", ".join(f"{v} AS {n}" for n, v in _caic_values().items()) + " FROM caic_days"


def _nwac_values() -> dict[str, str]:
    values = {
        "publish_datetime": "updated",
        "region_id": "'NWAC.' || area",
        "forecast_center": "'NWAC'",
        "analysis_datetime": "updated",
        "distribution_date": "day",
        "forecast_date": "day",
        "forecast_days_out": "CAST(0 AS BIGINT)",
        "forecast_date_season_day_number": day_number_sql("day"),
        "avalanche_season": season_sql("day"),
        "area_name": "coalesce(zone, 'undefined')",
        "area_id": "area",
        "polygons": "zone_id",
        "avalanche_summary": "CASE WHEN k % 3 = 2 THEN 'B' || k WHEN k % 5 > 1 THEN 'H' || k ELSE '' END",
        "danger_alp": "k % 6",
        "danger_tln": "(k // 6) % 6",
        "danger_btl": "(k // 36) % 6",
    }
    for s in SLOTS:
        own = f"(coalesce(type_{s}, 0) <> 0)"
        late = f"(coalesce(type_3, 0) <> 0 AND k % 3 = {s})"

        def chosen(name: str, zero: str, own: str = own, late: str = late, s: int = s) -> str:
            return f"(CASE WHEN {late} THEN {name}_3{zero} WHEN {own} THEN {name}_{s}{zero} ELSE 0 END)"

        values[f"problem_type_{s}"] = chosen("type", "")
        values[f"likelihood_{s}"] = chosen("likelihood", "")
        values[f"min_size_{s}"] = chosen("quantity", " / 10")
        values[f"max_size_{s}"] = chosen("quantity", " / 5")
        union = {
            e: f"((CASE WHEN {own} THEN {e}_{s} ELSE 0 END) | (CASE WHEN {late} THEN {e}_3 ELSE 0 END))"
            for e in ELEVATIONS
        }
        values |= _bits(s, union)
        counts = {e: f"bit_count({chosen(e, '')})" for e in ELEVATIONS}
        for e in ELEVATIONS:
            values[f"{e}_prevalence_{s}"] = f"CAST({counts[e]} AS BIGINT)"
        values[f"prevalence_{s}"] = "CAST(" + " + ".join(counts.values()) + " AS BIGINT)"
    return values


_NWAC_WALL = "(t0 + to_hours(k % 24) + to_hours(8 * (k % 2)))"


def nwac_rows(zones: str) -> str:
    """Bulletins with the zone that names them; ``zones`` gives (k, zone, zone_id)."""
    local = f"CAST(({_NWAC_WALL} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS DATE)"
    area = f"CAST(coalesce({code_sql(NWAC_AREA_IDS, 'zone')}, 2000 + k % 7) AS VARCHAR)"
    return (
        f"SELECT *, CASE WHEN zone IS NOT NULL THEN {area} END AS area FROM (SELECT *, {local} AS day, "
        f"{_NWAC_WALL} + INTERVAL 1 HOUR + to_milliseconds(250) AS updated, {zones} FROM bulletin WHERE k % 10 <> 7)"
    )


STEPS["nwac_rows"] = nwac_rows(
    f"CASE k % 3 WHEN 1 THEN {pick_sql(standin.ZONE_NAMES, 'k % 5')} "
    f"WHEN 2 THEN {pick_sql(standin.ZONE_NAMES, '(k // 5) % 5')} END AS zone, "
    "CASE k % 3 WHEN 1 THEN 'y' || (k % 9) WHEN 2 THEN 'z' || (k % 9) END AS zone_id"
)
_NWAC_SELECT = "SELECT k, " + ", ".join(f"{v} AS {n}" for n, v in _nwac_values().items())
STEPS["nwac"] = _NWAC_SELECT + " FROM nwac_rows"
STEPS["zone_rows"] = nwac_rows(
    f"unnest([{pick_sql(standin.ZONE_NAMES, 'k % 5')}, {pick_sql(standin.ZONE_NAMES, '(k // 5) % 5')}][:k % 3]) AS zone, "
    "unnest(['y' || (k % 9), 'z' || (k % 9)][:k % 3]) AS zone_id"
)
STEPS["nwac_zones"] = _NWAC_SELECT + " FROM zone_rows"
NEEDS["zone_rows"] = "bulletin"
NEEDS["nwac_zones"] = "zone_rows"


# --- forecasts of the aspect models -----------------------------------------------------------

# Added before rounding to four places, so that exact fractions do not sit on a tie.
OFF_TIE = 0.0000317


def rounded(value: str) -> str:
    return f"(round({value} + {OFF_TIE}, 4) + 0.0)"


def forecast_steps(name: str, rows: str, problems: list[str], gate: bool, keep: str) -> None:
    """Step with the 27 forecasts of the rows of another step."""
    columns = []
    for s in SLOTS:
        inputs = matched_sql(problems[s])
        for j, component in enumerate(SLOT_COMPONENTS, start=1):
            value = f"w{s}.w0[{j}] + " + " + ".join(f"w{s}.w[{i}][{j}] * x{s}[{i}]" for i in range(1, len(inputs) + 1))
            if gate:
                value = f"CASE WHEN {problems[s]} = 0 THEN 0.0::DOUBLE ELSE {value} END"
            columns.append(f"{value} AS forecast_{component}_{s}")
    arrays = ", ".join(f"[{', '.join(matched_sql(problems[s]))}] AS x{s}" for s in SLOTS)
    joins = " ".join(
        f"JOIN weights w{s} ON w{s}.region_id = r.region_id AND w{s}.model_year = r.model_year AND w{s}.slot = {s}"
        for s in SLOTS
    )
    STEPS[name] = f"SELECT {keep}, {', '.join(columns)} FROM (SELECT *, {arrays} FROM {rows}) r {joins}"
    NEEDS[name] = f"{rows} weights"


forecast_steps("forecasts", "chained", ["p0", "p1", "p2"], True, "r.region_id, r.forecast_date, r.model_year, p0, p1, p2")
forecast_steps(
    "tested", "test_frame", [f"target_problem_type_{s}" for s in SLOTS], False, "r.*"
)
STEPS["tested_pairs"] = " UNION ALL ".join(
    f"SELECT '{name}_{s}' AS model_name, region_id, model_year, target_{name}_{s} AS y_true, forecast_{name}_{s} AS y_pred FROM tested"
    for s in SLOTS
    for name in SLOT_COMPONENTS
)
NEEDS["tested_pairs"] = "tested"


def classification_sql(counts: str, group: str) -> str:
    """Macro metrics over the labels that occur as observed or forecast class."""
    return f"""SELECT {group}, CAST(sum(actual) AS BIGINT) AS n_rows, sum(hits) / sum(actual)::DOUBLE AS accuracy_score,
        avg(CASE WHEN predicted > 0 THEN hits / predicted::DOUBLE ELSE 0 END) AS precision_score,
        avg(CASE WHEN actual > 0 THEN hits / actual::DOUBLE ELSE 0 END) AS recall_score,
        avg(CASE WHEN actual + predicted > 0 THEN 2 * hits / (actual + predicted)::DOUBLE ELSE 0 END) AS f1_score
        FROM (SELECT {group}, label, sum(h) AS hits, sum(a) AS actual, sum(p) AS predicted FROM (
            SELECT {group}, y_true AS label, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS h, n AS a, 0 AS p FROM {counts}
            UNION ALL SELECT {group}, y_pred, 0, 0, n FROM {counts}) GROUP BY ALL) GROUP BY ALL"""


def regression_sql(pairs: str, group: str) -> str:
    return f"""SELECT {group}, n_rows, mae, mape, rmse, CASE WHEN n_rows < 2 THEN 'NaN'::DOUBLE
        WHEN lo = hi THEN CASE WHEN residual = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - residual / spread END AS r2 FROM (
        SELECT {group}, count(*) AS n_rows, avg(abs(y_true - y_pred)) AS mae,
            avg(abs(y_true - y_pred) / greatest(abs(y_true), 2.220446049250313e-16)) AS mape,
            sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, sum((y_true - y_pred) * (y_true - y_pred)) AS residual,
            var_pop(y_true) * count(*) AS spread, min(y_true) AS lo, max(y_true) AS hi FROM {pairs} GROUP BY ALL)"""


# --- bulletins kept up to date -------------------------------------------------------------------

STEPS["caic_winners"] = (
    "SELECT * FROM caic WHERE forecast_days_out = 0 AND avalanche_season <> 'OFF_SEASON' "
    "QUALIFY row_number() OVER (PARTITION BY region_id, forecast_date ORDER BY publish_datetime DESC) = 1"
)
NEEDS["caic_winners"] = "caic"
component_steps("caic_winners", "caic_masked", "caic_components")
