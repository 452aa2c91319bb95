"""Reference SQL for the order-dependent joins, stepping through the rows one by one.

Sources are selects with the columns ``k`` (key), ``ts``, ``t`` (numeric time), ``seq``, ``v``.
"""

from __future__ import annotations


def events(kind: str | None, key: str = "user_id") -> str:
    where = f"WHERE event_type = '{kind}'" if kind else ""
    return (
        f"SELECT {key} AS k, ts, epoch_us(ts) AS t, event_id AS seq, "
        f"CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS v FROM events {where}"
    )


def order_status(status: str) -> str:
    return (
        "SELECT o_orderpriority AS k, o_orderdate AS ts, epoch_us(o_orderdate) AS t, o_orderkey AS seq, "
        f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS v FROM orders WHERE o_orderstatus = '{status}'"
    )


def clocked(kind: str, step: float, where: str = "true", key: str = "user_id") -> str:
    """A source with a logical clock per key."""
    clock = f"(row_number() OVER (PARTITION BY k ORDER BY ts, seq) - 1) * CAST({step} AS DOUBLE)"
    stamped = f"SELECT k, {clock} AS ts, {clock} AS t, seq, v FROM ({events(kind, key)})"
    return f"SELECT * FROM ({stamped}) WHERE {where}"


def _ranked(**sources: str) -> str:
    return ",\n".join(
        f"{name} AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, seq) AS r FROM ({sql}))"
        for name, sql in sources.items()
    )


def _key(key: str | None, alias: str) -> str:
    return f"{alias}.k AS {key}, " if key else ""


def _fuzzy(s: str, t: str) -> str:
    return f"""WITH RECURSIVE {_ranked(s=s, t=t)},
need AS (SELECT s.k, s.r, count(t.r) AS lower FROM s LEFT JOIN t ON t.k = s.k AND t.t < s.t GROUP BY s.k, s.r),
step AS (
  SELECT k, r, lower + 1 AS p FROM need WHERE r = 1
  UNION ALL
  SELECT n.k, n.r, greatest(step.p, n.lower) + 1
  FROM step JOIN need n ON n.k = step.k AND n.r = step.r + 1
)"""


def fuzzy_merge(s: str, t: str, key: str | None, more: str = "") -> str:
    return f"""{_fuzzy(s, t)}
SELECT {_key(key, 's')}s.ts AS ts, s.v AS s_value, t.v AS t_value{more}
FROM step JOIN s ON s.k = step.k AND s.r = step.r JOIN t ON t.k = step.k AND t.r = step.p"""


def fuzzy_merge_drops(s: str, t: str, key: str | None) -> str:
    return f"""{_fuzzy(s, t)},
ends AS (SELECT k, max(t) AS last_t FROM s GROUP BY k)
SELECT {_key(key, 't')}t.ts AS ts, row_number() OVER (PARTITION BY t.k ORDER BY t.t, t.seq) AS dropped_so_far
FROM t JOIN ends ON ends.k = t.k AND t.t < ends.last_t
WHERE NOT EXISTS (SELECT 1 FROM step WHERE step.k = t.k AND step.p = t.r)"""


def _oldest(d: str, n: str) -> str:
    return f"""WITH RECURSIVE {_ranked(d=d, n=n)},
ready AS (SELECT d.k, d.r, count(n.r) AS upper FROM d LEFT JOIN n ON n.k = d.k AND n.t <= d.t GROUP BY d.k, d.r),
step AS (
  SELECT k, r, CASE WHEN upper > 0 THEN 1 ELSE 0 END AS used, upper > 0 AS hit FROM ready WHERE r = 1
  UNION ALL
  SELECT y.k, y.r, step.used + CASE WHEN step.used < y.upper THEN 1 ELSE 0 END, step.used < y.upper
  FROM step JOIN ready y ON y.k = step.k AND y.r = step.r + 1
)"""


def bufferless_oldest(d: str, n: str, key: str | None) -> str:
    return f"""{_oldest(d, n)}
SELECT {_key(key, 'd')}d.ts AS ts, d.v AS d_value, n.v AS n_value
FROM step JOIN d ON d.k = step.k AND d.r = step.r JOIN n ON n.k = step.k AND n.r = step.used
WHERE step.hit"""


def bufferless_drops(d: str, n: str, key: str | None) -> str:
    return f"""{_oldest(d, n)}
SELECT {_key(key, 'd')}d.ts AS ts, row_number() OVER (PARTITION BY d.k ORDER BY d.r) AS dropped_so_far
FROM step JOIN d ON d.k = step.k AND d.r = step.r WHERE NOT step.hit"""


def bufferless_newest(d: str, n: str, key: str | None) -> str:
    return f"""WITH RECURSIVE {_ranked(d=d, n=n)},
m AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, side, seq) AS at FROM (
    SELECT k, t, seq, r, 0 AS side FROM n UNION ALL SELECT k, t, seq, r, 1 AS side FROM d)
),
step AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT) AS at, CAST([] AS BIGINT[]) AS stack, CAST(NULL AS BIGINT) AS hit,
         CAST(NULL AS BIGINT) AS r FROM m
  UNION ALL
  SELECT m.k, m.at,
         CASE WHEN m.side = 0 THEN list_append(step.stack, m.r) ELSE step.stack[1:len(step.stack) - 1] END,
         CASE WHEN m.side = 1 THEN step.stack[len(step.stack)] END, m.r
  FROM step JOIN m ON m.k = step.k AND m.at = step.at + 1
)
SELECT {_key(key, 'd')}d.ts AS ts, d.v AS d_value, n.ts AS n_ts, n.v AS n_value
FROM step JOIN d ON d.k = step.k AND d.r = step.r JOIN n ON n.k = step.k AND n.r = step.hit"""


def alternating(one: str, two: str, key: str | None) -> str:
    def met(side: int, a: str, b: str) -> str:
        return f"""SELECT {a}.k, {side} AS side, {a}.r, {a}.t, count({b}.r) FILTER ({b}.t < {a}.t) AS lower,
  max({b}.t) FILTER ({b}.t < {a}.t) AS before_t, min({b}.t) FILTER ({b}.t >= {a}.t) AS after_t
  FROM {a} LEFT JOIN {b} ON {b}.k = {a}.k GROUP BY {a}.k, {a}.r, {a}.t"""

    return f"""WITH RECURSIVE {_ranked(a=one, b=two)},
met AS ({met(0, 'a', 'b')} UNION ALL {met(1, 'b', 'a')}),
-- mine and other count the rows that are used up on either side
walk AS (
  SELECT DISTINCT k, 0 AS side, CAST(0 AS BIGINT) AS mine, CAST(0 AS BIGINT) AS other FROM a
  UNION ALL
  SELECT w.k,
    CASE WHEN w.other < m.lower AND m.t - m.before_t <= m.after_t - m.t THEN 1 - w.side ELSE w.side END,
    CASE WHEN w.other < m.lower AND m.t - m.before_t <= m.after_t - m.t THEN m.lower ELSE w.mine + 1 END,
    CASE WHEN w.other >= m.lower THEN w.other + 1
         WHEN m.t - m.before_t <= m.after_t - m.t THEN w.mine ELSE m.lower END
  FROM walk w JOIN met m ON m.k = w.k AND m.side = w.side AND m.r = w.mine + 1
  WHERE w.other >= m.lower OR m.after_t IS NOT NULL
),
found AS (
  SELECT w.k, w.side, w.mine + 1 AS mine,
    CASE WHEN w.other >= m.lower THEN w.other + 1
         WHEN m.t - m.before_t <= m.after_t - m.t THEN m.lower ELSE m.lower + 1 END AS other
  FROM walk w JOIN met m ON m.k = w.k AND m.side = w.side AND m.r = w.mine + 1
  WHERE w.other >= m.lower OR m.after_t IS NOT NULL
)
SELECT {_key(key, 'f')}CASE f.side WHEN 0 THEN a.ts ELSE b.ts END AS ts, a.v AS value_1, b.v AS value_2
FROM found f JOIN a ON a.k = f.k AND a.r = CASE f.side WHEN 0 THEN f.mine ELSE f.other END
JOIN b ON b.k = f.k AND b.r = CASE f.side WHEN 0 THEN f.other ELSE f.mine END"""


def symmetric(one: str, two: str, key: str | None) -> str:
    return f"""WITH RECURSIVE u AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY t, side, seq) AS n FROM (
    SELECT k, ts, t, seq, v, 0 AS side FROM ({one}) UNION ALL SELECT k, ts, t, seq, v, 1 AS side FROM ({two}))
),
around AS (
  SELECT *, lag(side) OVER w AS side_before,
    max(CASE WHEN side = 0 THEN n END) OVER past AS past0, max(CASE WHEN side = 1 THEN n END) OVER past AS past1,
    min(CASE WHEN side = 0 THEN n END) OVER rest AS rest0, min(CASE WHEN side = 1 THEN n END) OVER rest AS rest1
  FROM u
  WINDOW w AS (PARTITION BY k ORDER BY n),
    past AS (PARTITION BY k ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    rest AS (PARTITION BY k ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
),
m AS (
  SELECT c.k, c.n, c.side, c.t, c.side_before, x.n AS x, x.t AS xt, y.n AS y, y.t AS yt
  FROM around c
  LEFT JOIN u x ON x.k = c.k AND x.n = CASE c.side WHEN 0 THEN c.past1 ELSE c.past0 END
  LEFT JOIN u y ON y.k = c.k AND y.n = CASE c.side WHEN 0 THEN c.rest1 ELSE c.rest0 END
),
-- per stream: the newest row taken as a later partner, and the oldest row that is not forgotten
walk AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS taken0, CAST(0 AS BIGINT) AS taken1,
    CAST(0 AS BIGINT) AS kept0, CAST(0 AS BIGINT) AS kept1, CAST(NULL AS BIGINT) AS p1, CAST(NULL AS BIGINT) AS p2 FROM u
  UNION ALL
  SELECT k, n,
    CASE WHEN side = 1 AND coalesce(p2, p1) = y THEN y ELSE taken0 END,
    CASE WHEN side = 0 AND coalesce(p2, p1) = y THEN y ELSE taken1 END,
    CASE WHEN side = 1 AND skip THEN n WHEN side = 1 THEN greatest(kept0, coalesce(p1, 0)) ELSE kept0 END,
    CASE WHEN side = 0 AND skip THEN n WHEN side = 0 THEN greatest(kept1, coalesce(p1, 0)) ELSE kept1 END,
    p1, p2
  FROM (
    SELECT *,
      CASE WHEN skip OR y IS NULL THEN NULL WHEN has_x AND t - xt <= yt - t THEN x ELSE y END AS p1,
      CASE WHEN skip OR y IS NULL THEN NULL WHEN has_x AND t - xt = yt - t THEN y END AS p2
    FROM (
      SELECT m.*, w.taken0, w.taken1, w.kept0, w.kept1,
        coalesce(m.side_before <> m.side AND CASE m.side WHEN 0 THEN w.taken0 ELSE w.taken1 END = m.n, false) AS skip,
        m.x IS NOT NULL AND m.x >= CASE m.side WHEN 0 THEN w.kept1 ELSE w.kept0 END AS has_x
      FROM walk w JOIN m ON m.k = w.k AND m.n = w.n + 1))
),
found AS (
  SELECT k, n, p1 AS p FROM walk WHERE p1 IS NOT NULL UNION ALL SELECT k, n, p2 FROM walk WHERE p2 IS NOT NULL
)
SELECT {_key(key, 'd')}d.ts AS ts, d.side + 1 AS dominant, d.v AS d_value, p.v AS p_value
FROM found f JOIN u d ON d.k = f.k AND d.n = f.n JOIN u p ON p.k = f.k AND p.n = f.p"""


def three_way(one: str, two: str, three: str, key: str | None) -> str:
    """Rows are numbered through, so that the number after a row is the next of its stream."""
    streams = " UNION ALL ".join(
        f"SELECT {i} AS side, k, ts, t, seq, v FROM ({sql})" for i, sql in enumerate((one, two, three))
    )

    def pick(i: int) -> str:
        second = f"w.dom <> {i} AND abs(d.t - h{i}.t) >= abs(d.t - h{i}.next_t)"
        return (
            f"w.n{i} + CASE WHEN {second} THEN 1 ELSE 0 END AS c{i}, "
            f"CASE WHEN {second} THEN h{i}.next_t ELSE h{i}.t END AS t{i}"
        )

    heads = " ".join(f"JOIN x h{i} ON h{i}.n = w.n{i} AND h{i}.starts = w.f{i}" for i in range(3))
    ready = " AND ".join(f"(w.dom = {i} OR h{i}.next_t IS NOT NULL)" for i in range(3))
    state = "w.k, w.dom, w.n0, w.n1, w.n2, w.f0, w.f1, w.f2"
    steps = f"""SELECT {state}, d.n AS dn, {pick(0)}, {pick(1)}, {pick(2)}
  FROM walk w {heads} JOIN x d ON d.n = CASE w.dom WHEN 0 THEN w.n0 WHEN 1 THEN w.n1 ELSE w.n2 END
  WHERE {ready}"""
    moved = ", ".join(f"n{i} + CASE ahead WHEN {i} THEN 1 ELSE 0 END" for i in range(3))
    return f"""WITH RECURSIVE numbered AS (
  SELECT *, row_number() OVER (ORDER BY k, side, t, seq) AS n, lead(t) OVER (PARTITION BY k, side ORDER BY t, seq) AS next_t
  FROM ({streams})
),
x AS (SELECT *, min(n) OVER (PARTITION BY k, side) AS starts FROM numbered),
walk AS (
  SELECT k, 0 AS dom, n0, n1, n2, n0 AS f0, n1 AS f1, n2 AS f2 FROM (
    SELECT k, min(n) FILTER (side = 0) AS n0, min(n) FILTER (side = 1) AS n1, min(n) FILTER (side = 2) AS n2
    FROM x GROUP BY k)
  UNION ALL
  SELECT k, ahead, {moved}, f0, f1, f2
  FROM (SELECT *, CASE WHEN t0 <= t1 AND t0 <= t2 THEN 0 WHEN t1 <= t2 THEN 1 ELSE 2 END AS ahead FROM ({steps}))
),
found AS ({steps})
SELECT {_key(key, 'f')}d.ts AS ts, d.v AS value, a.v AS v1, b.v AS v2, c.v AS v3
FROM found f JOIN x d ON d.n = f.dn JOIN x a ON a.n = f.c0 JOIN x b ON b.n = f.c1 JOIN x c ON c.n = f.c2"""
