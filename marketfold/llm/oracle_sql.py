"""DuckDB SQL of the queries that SQL can express on whole tables."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
i AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all({LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS p FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dp AS (SELECT r, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, lens WHERE len(w) >= n),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS s FROM dp),
m AS (SELECT dw.r, dw.p, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.s = iw.s),
hits AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)
"""

def _position(share: str) -> str:
    """CASE over the curriculum's pieces, from the same knots."""
    from marketfold.llm.curriculum import SCHEDULES
    kinds = []
    for k, schedule in enumerate(SCHEDULES):
        pieces, arms = schedule.pieces(), []
        for i, (lo, hi, t0, w0, slope) in enumerate(pieces):
            due = f"greatest({share} - {lo!r}, 0.0::DOUBLE)"
            root = f"sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {due}, 0.0::DOUBLE))"
            t = f"{t0!r} + CASE WHEN {due} > 0 THEN 2 * {due} / ({w0!r}::DOUBLE + {root}) ELSE 0.0 END"
            arms.append(f"WHEN {share} < {hi!r}::DOUBLE THEN {t}" if i < len(pieces) - 1 else f"ELSE {t}")
        case = f"CASE {' '.join(arms)} END" if len(arms) > 1 else arms[0].removeprefix("ELSE ")
        kinds.append(f"WHEN rank % {len(SCHEDULES)} = {k} THEN least({case}, 1.0)")
    return f"CASE {' '.join(kinds)} END"


OP4 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][rank % 3 + 1] AS DOUBLE) AS weight, 2 * source_size AS cap FROM s),
f AS (
  SELECT *, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) AS total,
         coalesce(CAST(sum(cap) OVER p AS BIGINT), 0) AS full_caps,
         sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS rest
  FROM w WINDOW p AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT (total - full_caps) / rest AS level FROM f
  WHERE (total - full_caps) / rest * weight <= cap ORDER BY cap / weight, rank LIMIT 1),
t AS (SELECT source, source_size, rank, least(CAST(cap AS DOUBLE), coalesce((SELECT level FROM l), 0) * weight) AS target FROM f),
q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.rank,
         coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start,
         CAST(round(t.target) AS BIGINT) AS due
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (
  SELECT *, start / target AS share, greatest(0, least(size, due - start)) + greatest(0, least(size, due - source_size - start)) AS taken FROM q)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN {_position("share")} END AS position
FROM x
"""

_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM d),
k AS (SELECT *, {LOWER.format(f"trim(line, {_STRIP})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.r, k.p, k.line, f.key IS NOT NULL AND k.doc_id <> f.first AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM d JOIN j USING (r) GROUP BY d.r, d.doc_id, d.lines
"""

OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
f AS (
  SELECT doc_id, part, len(w) < 50 AS a, 100 * len(list_distinct(w)) < 65 * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(first < coalesce(doc_id, 9223372036854775807), false) AS e
  FROM (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS first FROM d)),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
p AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS pattern, count(*) AS n,
         count(*) FILTER (coalesce(good, false)) AS good, count(*) FILTER (coalesce(toxic, false)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT x1.x || x2.x || x3.x || x4.x || x5.x AS filter_order, [x1.bit, x2.bit, x3.bit, x4.bit, x5.bit] AS bits
  FROM x x1, x x2, x x3, x x4, x x5
  WHERE len(list_distinct([x1.x, x2.x, x3.x, x4.x, x5.x])) = 5),
s AS (
  SELECT filter_order, step::INT AS step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS earlier
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (pattern & (own | earlier) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (pattern & own > 0 AND pattern & earlier = 0), 0) AS removed,
         coalesce(sum(n) FILTER (pattern & own > 0 AND pattern & earlier > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (pattern = own), 0) AS unique_fails,
         coalesce(sum(good) FILTER (pattern & own > 0 AND pattern & earlier = 0), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (pattern & own > 0 AND pattern & earlier = 0), 0) AS toxic_lost
  FROM p, s GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""

ORACLES = {"op2_decontamination": OP2, "op4_curriculum_mix": OP4, "op5_line_ledger": OP5, "op12_filter_audit": OP12}
