"""DuckDB text of the derived views in :mod:`reelsight.sources.testdata`.

Oracle SQL strings start with ``WITH`` followed by the views they need; the
base tables are registered in DuckDB under their own names.  DuckDB's
``epoch()`` of a timestamp is a double whose cast rounds, hence ``floor``.
"""

from __future__ import annotations

import re

EPOCH = "CAST(floor(epoch({c})) AS BIGINT)"

VIEWS: dict[str, str] = {
    "interactions": f"""
        SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, l.l_quantity / 10.0 AS rating,
               {EPOCH.format(c='l.l_shipdate')} AS ts,
               l.l_orderkey, l.l_linenumber, l.l_suppkey
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "responses": f"""
        SELECT event_id AS request_id, user_id, {EPOCH.format(c='ts')} AS ts, value AS latency_ms,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k0,
               range(CAST(json_extract_string(props, '$.k') AS BIGINT),
                     CAST(json_extract_string(props, '$.k') AS BIGINT) + 20) AS movie_ids
        FROM events WHERE event_type = 'view'""",
    "resp_items": """
        SELECT r.request_id, r.user_id, r.ts, g.pos + 1 AS pos, r.k0 + g.pos AS movie_id
        FROM responses r CROSS JOIN (SELECT unnest(range(0, 20)) AS pos) g""",
    "watches": f"""
        SELECT event_id AS watch_id, user_id, {EPOCH.format(c='ts')} AS ts,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id
        FROM events WHERE event_type = 'click'""",
    "request_log": f"""
        SELECT event_id AS request_id, user_id, {EPOCH.format(c='ts')} AS ts,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
               value AS latency_ms, event_type
        FROM events""",
}

# Which views each view reads (so ``with_views`` emits them in order).
DEPENDS = {"resp_items": ("responses",)}


def with_views(sql: str, *names: str) -> str:
    ordered: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, ()):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    body = sql.strip()
    word = "WITH RECURSIVE" if any(re.search(rf"\b{n}\b", VIEWS[n]) for n in ordered) else "WITH"
    if body.upper().startswith("WITH "):
        return f"{word} {ctes},\n{body[5:]}"
    return f"{word} {ctes}\n{body}"


def add_view(name: str, sql: str, depends: tuple[str, ...] = ()) -> None:
    VIEWS[name] = sql
    if depends:
        DEPENDS[name] = depends
