"""Small helpers that write the DuckDB oracle SQL for the query catalog.

These only build SQL text for the correctness check; nothing here runs on
Spark.
"""

from __future__ import annotations


def pretty_sql(expr: str) -> str:
    """SQL twin of ``functions.cells.pretty_number``."""
    return f"regexp_replace(printf('%f', CAST({expr} AS DOUBLE)), '[.]?0+$', '')"


def header_values(columns: list[str]) -> str:
    rows = ", ".join(f"({i}, '{c}')" for i, c in enumerate(columns))
    return f"(VALUES {rows})"


def nearest_sql(points: str, centers: str, key: str, d: int) -> str:
    """``(key, cluster, d2)``: nearest center per point; ties -> lowest id.
    ``points(key, x DOUBLE[])``, ``centers(cluster, c DOUBLE[])``."""
    return f"""
      SELECT p.{key} AS {key},
             arg_min(c.cluster, struct_pack(d := {dist_sql('p.x', 'c.c', d)}, c := c.cluster)) AS cluster,
             min({dist_sql('p.x', 'c.c', d)}) AS d2
      FROM {points} p CROSS JOIN {centers} c
      GROUP BY p.{key}"""


def dist_sql(a: str, b: str, d: int) -> str:
    return f"list_sum(list_transform(range(1, {d + 1}), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])))"


def mean_vector_sql(src: str, group: str, d: int, x: str = "x") -> str:
    """Per-group mean vector over ``src(group, x DOUBLE[])``."""
    items = ", ".join(f"avg({x}[{i + 1}])" for i in range(d))
    return f"SELECT {group}, [{items}] AS c, count(*) AS n FROM {src} GROUP BY {group}"


def lloyd_sql(points: str, key: str, ks: list[int], iterations: int, d: int) -> str:
    """CTEs for Lloyd runs of every k in ``ks`` from the first-k-by-key start.
    Defines ``final_centers(k, cluster, c)`` and ``final_cost(k, wssse)``."""
    ctes = [f"pts AS (SELECT {key} AS key, x FROM {points})",
            "seed AS (SELECT key, x, CAST(row_number() OVER (ORDER BY key) AS INTEGER) AS rn1 FROM pts)"]
    ctes.append("c0 AS (" + " UNION ALL ".join(
        f"SELECT {k} AS k, rn1 - 1 AS cluster, x AS c FROM seed WHERE rn1 <= {k}"
        for k in ks) + ")")
    dist = dist_sql("p.x", "c.c", d)
    for it in range(iterations):
        prev, cur = f"c{it}", f"c{it + 1}"
        ctes.append(f"""a{it} AS (
            SELECT c.k, p.key, p.x,
                   arg_min(c.cluster, struct_pack(d := {dist}, c := c.cluster)) AS cluster
            FROM pts p CROSS JOIN {prev} c GROUP BY c.k, p.key, p.x)""")
        means = ", ".join(f"avg(x[{i + 1}])" for i in range(d))
        ctes.append(f"""u{it} AS (SELECT k, cluster, [{means}] AS c FROM a{it} GROUP BY k, cluster)""")
        # empty clusters keep their center
        ctes.append(f"""{cur} AS (
            SELECT k, cluster, c FROM u{it}
            UNION ALL
            SELECT o.k, o.cluster, o.c FROM {prev} o
            WHERE NOT EXISTS (SELECT 1 FROM u{it} u WHERE u.k = o.k AND u.cluster = o.cluster))""")
    last = f"c{iterations}"
    ctes.append(f"final_centers AS (SELECT * FROM {last})")
    ctes.append(f"""final_assign AS (
        SELECT c.k, p.key, min({dist}) AS d2,
               arg_min(c.cluster, struct_pack(d := {dist}, c := c.cluster)) AS cluster
        FROM pts p CROSS JOIN {last} c GROUP BY c.k, p.key)""")
    ctes.append("final_cost AS (SELECT k, sum(d2) AS wssse, count(*) AS n FROM final_assign GROUP BY k)")
    return "WITH " + ",\n".join(ctes)


def case_map(expr: str, table: dict[str, float], on_unmapped: str = "null") -> str:
    """SQL CASE twin of a code-table lookup (value texts as the library
    writes them)."""
    from cellar.operators.recode_tables import value_text
    whens = " ".join(f"WHEN '{code}' THEN '{value_text(v)}'" for code, v in table.items())
    other = {"null": "NULL", "keep": expr}.get(on_unmapped, "NULL")
    return f"(CASE {expr} {whens} ELSE {other} END)"


def missing_sql(expr: str) -> str:
    return f"({expr} IS NULL OR {expr} IN ('', '0', '0.0'))"
