"""DuckDB SQL of the training-data queries that SQL can express on whole tables."""

from __future__ import annotations


def clusters(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256) -> str:
    """Lloyd's method unrolled: every round measures every vector against every centroid."""
    largest = 1 << 27
    numbers = f"list_transform(embedding, lambda x: CAST(greatest(-{largest}, least({largest}, floor({scale} * CAST(x AS DOUBLE)))) AS BIGINT))"
    parts = [
        f"kept AS (SELECT row_number() OVER () AS r, vec_id, {numbers} AS v FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim})",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY 1, 2 LIMIT {k}))",
    ]
    for i in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        parts.append(f"m{i} AS MATERIALIZED (SELECT r, vec_id, v, best.c AS c, best.d AS d FROM (SELECT a.r, any_value(a.vec_id) AS vec_id, any_value(a.v) AS v, min({{'d': CAST({distance} AS BIGINT), 'c': b.c}}) AS best FROM kept a CROSS JOIN c{i} b GROUP BY a.r))")
        if i < rounds:
            summed = f"SELECT c, nth, sum(v[nth]) AS s, count(*) AS n FROM m{i}, (SELECT unnest(range(1, {dim + 1})) AS nth) GROUP BY c, nth"
            mean = "CAST((s - (((s % n) + n) % n)) // n AS BIGINT)"
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c, coalesce(new.v, old.v) AS v FROM c{i} old LEFT JOIN (SELECT c, list({mean} ORDER BY nth) AS v FROM ({summed}) GROUP BY c) new USING (c))")
    last = f"m{rounds}"
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(c AS INT) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(b.v, ',')) AS centroid_sha256
FROM (SELECT vec_id, c, d FROM {last}) JOIN c{rounds} b USING (c)"""


def near_vectors(threshold: float = 0.9) -> str:
    """All pairs by cosine, and everything that links reach. Scaled by the largest component first, as squares may overflow."""
    return f"""WITH RECURSIVE rows AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS raw FROM embeddings),
fine AS MATERIALIZED (SELECT r, vec_id, list_transform(raw, lambda x: x / list_max(list_transform(raw, lambda y: abs(y)))) AS v FROM rows
    WHERE len(raw) > 0 AND len(list_filter(raw, lambda x: isfinite(x))) = len(raw) AND len(list_filter(raw, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM fine a, fine b WHERE a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {threshold}),
reach AS (SELECT r AS a, r AS b FROM rows UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
joined AS (SELECT reach.a AS r, min(rows.vec_id) AS component_id FROM reach JOIN rows ON rows.r = reach.b GROUP BY 1),
counts AS (SELECT a AS r, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(vec_id = component_id, n IS NULL) AS kept
FROM rows JOIN joined USING (r) LEFT JOIN counts USING (r)"""


def repaired_conversations() -> str:
    """A forward pass over every conversation: for each state, the least cost so far, the least audit of that cost, and the
    turns it gives, as one text that sorts by cost and audit."""
    symbol = chr(1)

    def best(*ways: str) -> str:
        """The least of the texts; list_min skips nulls."""
        return f"list_min([{', '.join(ways)}])"

    def add(state: str, cost: str, edit: str, turn: str | None = None) -> str:
        """`state` followed by an edit; null where either is null."""
        head = f"lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || split_part(substr({state}, 10), '{symbol}', 1) || '{edit}{symbol}'"
        body = f"substr({state}, instr({state}, '{symbol}') + 1)"
        return f"({head} || {body})" if turn is None else f"({head} || {body} || {turn} || chr(10))"

    def inserted(z: str) -> str:
        """The states of `z` after inserts too: a user's turn, then an assistant's, then a user's after that; a further one
        would only lead back at a higher cost."""
        one = best("s2", *(add(x, "2", "I", "'user:'") for x in ("s0", "s1", "s3")))
        two = best("s3", add("u", "2", "I", "'assistant:'"))
        three = best("u", add("a", "2", "I", "'user:'"))
        return f"SELECT conv, n, s0, s1, {three} AS s2, a AS s3 FROM (SELECT *, {two} AS a FROM (SELECT *, {one} AS u FROM {z}))"

    turn = "(r.role || ':' || r.text)"
    user, assistant = "('user:' || r.text)", "('assistant:' || r.text)"
    keep = lambda state, initial: f"CASE WHEN r.initial = '{initial}' AND NOT r.gone THEN {add(state, 'r.late', 'K', turn)} END"
    role = lambda state, said: f"CASE WHEN NOT r.gone THEN {add(state, '(2 + r.late)', 'R', said)} END"
    to0 = add("p.s0", "3", "D")
    to1 = best(add("p.s1", "3", "D"), keep("p.s0", "s"))
    to2 = best(add("p.s2", "3", "D"), *(f(s) for s in ("p.s0", "p.s1", "p.s3") for f in (lambda s: keep(s, "u"), lambda s: role(s, user))))
    to3 = best(add("p.s3", "3", "D"), keep("p.s2", "a"), role("p.s2", assistant))
    start, none = f"'000000000{symbol}'", "CAST(NULL AS VARCHAR)"
    return f"""WITH RECURSIVE spaced AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
bytes AS (SELECT name, list_transform(range(octet_length(encode(name))), lambda i: CAST(ascii(name[i + 1]) AS BIGINT)) AS b FROM (SELECT DISTINCT name FROM spaced)),
sums AS (SELECT name, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: {_crc_byte("c", "x")}), 4294967295) % 20 AS kind FROM bytes),
hit AS (SELECT conv_id, turn, kind, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM spaced JOIN sums USING (name)),
ids AS (SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)),
stood AS (SELECT conv, turn, role, text, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS n
    FROM hit JOIN ids ON hit.conv_id IS NOT DISTINCT FROM ids.conv_id, (SELECT unnest([1, 2]) AS time) WHERE kind <> 0 AND (time = 1 OR kind = 3)),
judged AS (SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY conv, role, text ORDER BY n) > 1 AS again FROM stood),
r AS MATERIALIZED (SELECT conv, n, turn, role, text, initial, body = '' AS blank, body <> '' AND again AS duplicate, body = '' OR again AS gone,
    CASE WHEN body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS late, lag(initial) OVER (PARTITION BY conv ORDER BY n) AS before FROM judged),
told(conv, n, s0, s1, s2, s3) AS (
    {inserted(f"(SELECT conv, CAST(0 AS BIGINT) AS n, {start} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM ids)")}
    UNION ALL
    {inserted(f"(SELECT p.conv, r.n, {to0} AS s0, {to1} AS s1, {to2} AS s2, {to3} AS s3 FROM told p JOIN r ON r.conv = p.conv AND r.n = p.n + 1)")}),
ends AS (SELECT conv, list_min([s0, s3]) AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY n DESC) AS back FROM told) WHERE back = 1),
facts AS (SELECT conv, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, sum(late) AS truncated,
    count(*) FILTER (n > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, coalesce(illegal, 0) AS illegal,
    CAST(left(best, 9) AS BIGINT) AS cost, split_part(substr(best, 10), '{symbol}', 1) AS audit, sha256(regexp_replace(substr(best, instr(best, '{symbol}') + 1), chr(10) || '$', '')) AS repaired_sha256
FROM ids JOIN ends USING (conv) LEFT JOIN facts USING (conv)"""


def _crc_byte(crc: str, byte: str) -> str:
    """One byte of CRC-32: its eight shifts are linear, so the table's entry is a sum (xor) over the set bits."""
    entries = []
    for bit in range(8):
        c = 1 << bit
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        entries.append(c)
    low = f"xor({crc} & 255, {byte})"
    out = f"({crc} >> 8)"
    for bit, entry in enumerate(entries):
        out = f"xor({out}, CASE WHEN ({low} >> {bit}) & 1 = 1 THEN {entry} ELSE 0 END)"
    return out
