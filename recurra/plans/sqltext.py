"""Small builders for the DuckDB oracle SQL (same rounding/division rules as Spark)."""

from __future__ import annotations

import re


def rnd(expr: str, digits: int, scale: int = 12) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,{scale})), {digits}) AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"(CAST(({num}) AS DOUBLE) / NULLIF(CAST(({den}) AS DOUBLE), 0))"


def dax_div(num: str, den: str) -> str:
    return f"COALESCE({div(num, den)}, 0.0)"


def month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def days_to(start: str, end: str) -> str:
    return f"date_diff('day', {start}, {end})"


def tenure_days(as_of: str, s: str = "") -> str:
    p = f"{s}." if s else ""
    end = (f"CASE WHEN {p}status = 'Churned' AND {p}end_date IS NOT NULL "
           f"THEN {p}end_date ELSE DATE '{as_of}' END")
    return days_to(f"{p}start_date", end)


def case(expr: str, mapping: dict, quote: bool = True) -> str:
    whens = " ".join(
        f"WHEN {k!r} THEN {repr(v) if quote and isinstance(v, str) else v}"
        if isinstance(k, str) else
        f"WHEN {k} THEN {repr(v) if quote and isinstance(v, str) else v}"
        for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def pick(expr: str, values: list) -> str:
    return case(expr, dict(enumerate(values)))


def _inline_ctes(cte_list: str) -> str:
    """Mark every top-level ``name AS (`` of a CTE list NOT MATERIALIZED.

    DuckDB materializes CTEs referenced more than once; its dictionary cache on
    that path can hit an internal assertion, so the oracle asks for inlining.
    """
    out, i, depth, n = [], 0, 0, len(cte_list)
    pat = re.compile(r"(\w+)\s+AS\s+\(", re.IGNORECASE)
    expect_name = True
    while i < n:
        ch = cte_list[i]
        if depth == 0 and expect_name:
            m = pat.match(cte_list, i)
            if not m:                       # the CTE list is over: copy the query as is
                out.append(cte_list[i:])
                break
            out.append(f"{m.group(1)} AS NOT MATERIALIZED (")
            i = m.end()
            depth = 1
            expect_name = False
            continue
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            expect_name = True
            out.append(ch)
            i += 1
            while i < n and cte_list[i].isspace():
                out.append(cte_list[i])
                i += 1
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    """Prefix ``body`` with CTEs; a body that starts with its own WITH is merged.
    All CTEs are inlined (NOT MATERIALIZED)."""
    head = ",\n".join(f"{name} AS NOT MATERIALIZED (\n{sql}\n)" for name, sql in ctes)
    b = body.strip()
    if b[:5].upper() == "WITH ":
        return f"WITH {head},\n{_inline_ctes(b[5:])}"
    return f"WITH {head}\n{b}"
