"""DuckDB SQL for the queries that SQL can express over whole tables."""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_LETTERS}) AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
          FROM doc, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
gram AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s FROM place),
hit AS (SELECT g.doc_id, g.i, g.k, win.item_id FROM gram g JOIN win ON g.k = win.k AND g.s = win.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(doc.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(doc.w) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """Every round is a plain comparison of all vectors with all centroids."""
    steps = []
    for r in range(rounds + 1):
        squared = "list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        steps.append(f"near{r} AS (SELECT rid, min({{'d': CAST({squared} AS BIGINT), 'c': c}}) AS best FROM kept, c{r} GROUP BY rid)")
        if r < rounds:
            steps += [
                f"sum{r} AS (SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM near{r} JOIN kept USING (rid), range(1, 65) t(i) GROUP BY ALL)",
                f"mean{r} AS (SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM sum{r} GROUP BY c)",
                f"c{r + 1} AS (SELECT c{r}.c, coalesce(mean{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN mean{r} USING (c))",
            ]
    fits = "x IS NOT NULL AND isfinite(x) AND abs(256 * CAST(x AS DOUBLE)) <= 67108864"
    return f"""
WITH kept AS (SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: {fits})) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256(concat('2:', vec_id)), v) - 1 AS c, v AS m FROM kept QUALIFY c < {k}),
{", ".join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, best.d AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (rid) JOIN c{rounds} ON best.c = c{rounds}.c
"""


def _with_edit(state: str, cost: str, initial: str, message: str = "NULL") -> str:
    """A way's cost (nine digits), audit, chr(1) and messages, with one more edit before them."""
    at = f"strpos({state}, chr(1))"
    rest = f"substr({state}, {at} + 1)"
    joined = f"CASE WHEN {message} IS NULL THEN {rest} WHEN {rest} = '' THEN {message} ELSE concat({message}, chr(10), {rest}) END"
    total = f"lpad(CAST(CAST(left({state}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0')"
    return f"concat({total}, '{initial}', substr({state}, 10, {at} - 10), chr(1), {joined})"


def _repair() -> str:
    """Rows are taken from the last; s0 to s3 are the best ways on from each grammar state."""
    to_user, to_assistant = "concat('user:', t)", "concat('assistant:', t)"
    whole = "concat(role, ':', t)"

    def step(state, keeps, role, after):
        kept = " ".join(f"WHEN i = '{c}' THEN {_with_edit(to, 'more', 'K', whole)}" for c, to in keeps)
        return (
            f"least({_with_edit(state, '4', 'D')}, CASE WHEN goes THEN NULL {kept} END,"
            f" CASE WHEN NOT goes THEN {_with_edit(after, '3 + more', 'R', role)} END)"
        )

    def insert(state, role):
        return _with_edit(state, "3", "I", f"'{role}:'")

    ends = [f"concat(lpad('{cost}', 9, '0'), '{audit}', chr(1), {text})" for cost, audit, text in (
        (0, "", "''"), (6, "II", "concat('user:', chr(10), 'assistant:')"), (3, "I", "'assistant:'"), (0, "", "''"))]
    return f"""
WITH RECURSIVE bytes AS (SELECT list(list_reduce(list_concat([i], range(8)),
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS tab FROM range(256) b(i)),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS k FROM conversations),
drawn AS (SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1])), 4294967295) % 20 AS kind FROM given, bytes),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS t,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS twice FROM drawn WHERE kind <> 0),
groups AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT g, turn, role, t, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, t) AS pos
  FROM damaged JOIN groups ON damaged.conv_id IS NOT DISTINCT FROM groups.conv_id),
judged AS (SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY pos) AS before,
    CASE WHEN NOT regexp_matches(t, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY g, role, t ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(t, '[.!?][\x20\x09-\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
ready AS (SELECT *, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM judged),
sized AS (SELECT g, conv_id, count(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count_if(fault = 'blank') AS blank, count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
    count_if(pos > 1 AND concat(before, i) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM groups LEFT JOIN ready USING (g) GROUP BY g, conv_id),
ways AS (
  SELECT g, n AS pos, {", ".join(f"{e} AS s{q}" for q, e in enumerate(ends))} FROM sized
  UNION ALL
  SELECT g, pos - 1, least(n0, {insert("i2", "user")}), least(n1, {insert("i2", "user")}), i2, i3 FROM (
    SELECT *, least(n2, {insert("n3", "assistant")}) AS i2, least(n3, {insert("n2", "user")}) AS i3 FROM (
      SELECT ways.g, ways.pos, {step("s0", (("s", "s1"), ("u", "s2")), to_user, "s2")} AS n0,
        {step("s1", (("u", "s2"),), to_user, "s2")} AS n1, {step("s2", (("a", "s3"),), to_assistant, "s3")} AS n2,
        {step("s3", (("u", "s2"),), to_user, "s2")} AS n3
      FROM ways JOIN ready ON ways.g = ready.g AND ways.pos = ready.pos)))
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, CAST(left(s0, 9) AS BIGINT) AS cost,
  substr(s0, 10, strpos(s0, chr(1)) - 10) AS audit, sha256(substr(s0, strpos(s0, chr(1)) + 1)) AS repaired_sha256
FROM ways JOIN sized USING (g) WHERE pos = 0
"""


ORACLES = {
    "op4_exact_dedup": EXACT_DEDUP,
    "op9_decontamination": DECONTAMINATION,
    "op12_conversation_repair": _repair(),
    "op13_ptolemaic_clusters": _clusters(),
}
