"""DuckDB SQL for the audit of damaged conversations: the repair's programme as a recursive query."""

from __future__ import annotations

EXPECTED = ("user", "user", "assistant", "user")
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def _moves() -> str:
    """(state, edits, cost, state after, text of the inserts, edit, needed initial or given role) of one row's edits."""
    rows = []
    for state in range(4):
        rows.append(f"({state}, 'D', 2, {state}, '', 'D', '')")
        after, text = state, ""
        for inserts in range(3):
            edits, cost = "I" * inserts, 5 * inserts
            rows += [f"({state}, '{edits}K', {cost}, {to}, '{text}', 'K', '{letter}')" for (at, letter), to in NEXT.items() if at == after]
            role = EXPECTED[after]
            rows.append(f"({state}, '{edits}R', {cost + 1}, {NEXT[after, role[0]]}, '{text}', 'R', '{role}')")
            after, text = NEXT[after, role[0]], f"{text}{role}:|"
    return ", ".join(rows)


BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(mark, ''), lambda c: CAST(ord(c) AS BIGINT))),
    lambda x, b: list_reduce(list_prepend(xor(x, b), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) % 20"""

REPAIR_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS mark
  FROM conversations
), faults AS (SELECT *, {CRC} AS fault FROM marked),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM faults WHERE fault <> 0
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         rtrim(text, {BLANKS}) AS core
  FROM damaged
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial, core = '' AS blank, core <> '' AND again AS duplicate,
         core <> '' AND NOT again AND right(core, 1) NOT IN ('.', '!', '?') AS truncated,
         coalesce(concat(lag(substr(role, 1, 1)) OVER w, substr(role, 1, 1)) NOT IN ('su', 'ua', 'au') AND lag(role) OVER w IS NOT NULL, FALSE) AS illegal
  FROM seen WINDOW w AS (PARTITION BY conv_id ORDER BY n)
), moves(q, edits, cost, after, pre, kind, given) AS (VALUES {_moves()}),
all_moves AS (
  SELECT list({{'q': q, 'edits': edits, 'cost': cost, 'after': after, 'pre': replace(pre, '|', chr(10)), 'kind': kind, 'given': given}}) AS ms FROM moves
), walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, [{{'c': CAST(0 AS BIGINT), 'a': '', 'q': 0, 't': ''}}] AS states FROM conversations
  UNION ALL
  SELECT conv_id, n, list_filter(list_transform([0, 1, 2, 3], lambda q: list_min(list_filter(ways, lambda w: w.q = q))), lambda w: w IS NOT NULL)
  FROM (
    SELECT j.conv_id, j.n, flatten(list_transform(states, lambda s: list_transform(
        list_filter(ms, lambda m: m.q = s.q AND (m.kind = 'D' OR NOT (blank OR duplicate) AND (m.kind = 'R' OR m.given = initial))),
        lambda m: {{'c': s.c + m.cost + CASE WHEN truncated AND m.kind <> 'D' THEN 5 ELSE 0 END, 'a': concat(s.a, m.edits), 'q': m.after,
          't': CASE WHEN m.kind = 'D' THEN s.t ELSE concat(s.t, m.pre, CASE WHEN m.kind = 'R' THEN m.given ELSE role END, ':', text, chr(10)) END}}))) AS ways
    FROM walk JOIN judged j ON j.conv_id IS NOT DISTINCT FROM walk.conv_id AND j.n = walk.n + 1, all_moves
  )
), ended AS (
  SELECT conv_id, list_min(list_transform(states, lambda s: {{
      'c': s.c + CASE s.q WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, 'a': concat(s.a, CASE s.q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END),
      't': concat(s.t, CASE s.q WHEN 1 THEN concat('user:', chr(10), 'assistant:', chr(10)) WHEN 2 THEN concat('assistant:', chr(10)) ELSE '' END)}})) AS best
  FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1
), counted AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         CAST(sum(CAST(blank AS INTEGER)) AS BIGINT) AS blank, CAST(sum(CAST(duplicate AS INTEGER)) AS BIGINT) AS duplicate,
         CAST(sum(CAST(truncated AS INTEGER)) AS BIGINT) AS truncated, CAST(sum(CAST(illegal AS INTEGER)) AS BIGINT) AS illegal,
         count(*) AS n_rows
  FROM judged GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(left(best.t, greatest(length(best.t) - 1, 0))) AS repaired_sha256, coalesce(n_rows, 0) AS n_rows,
       CAST(length(replace(best.a, 'D', '')) AS BIGINT) AS n_repaired
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
