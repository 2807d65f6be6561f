"""The SQL that gives each query's rows on the same tables, in DuckDB's dialect."""

from __future__ import annotations

_SPLIT = """
  SELECT doc_id, lang, source, n, r, ceil(round(n * 0.1, 9)) AS n_test,
         ceil(round((n - ceil(round(n * 0.1, 9))) * (0.1 / (1 - 0.1)), 9)) AS n_val
  FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY doc_id) AS r FROM documents)
"""
_SPLIT_NAME = "CASE WHEN r <= n - n_test - n_val THEN 'train' WHEN r <= n - n_test THEN 'validation' ELSE 'test' END AS split"


def _key(seed: str, *parts: str) -> str:
    return "md5(concat_ws('|', " + ", ".join([f"CAST({seed} AS VARCHAR)", *(f"CAST({p} AS VARCHAR)" for p in parts)]) + "))"


def _draw(seed: str, n: str, *parts: str) -> str:
    return f"(CAST('0x' || substr({_key(seed, *parts)}, 1, 8) AS BIGINT) % {n})"


def _fingerprint(*columns: str) -> str:
    parts = ", ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, 'null')" for c in columns)
    return f"(sum(CAST('0x' || substr(md5(concat_ws('|', {parts})), 1, 15) AS BIGINT)) % {(1 << 61) - 1})::BIGINT"


_X = "(SELECT vec_id, label, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings)"
_RMS = "sqrt(list_sum(list_transform({0}, lambda v: v * v)) / len({0}))"


def _rounded(x: str, digits: int = 6) -> str:
    return f"list_transform({x}, lambda v: round(v, {digits}) + 0.0)"


def _zeros(n: str) -> str:
    return f"list_transform(range(0, greatest({n}, 0)), lambda i: 0.0::DOUBLE)"


def _membership(condition: str) -> str:
    return f"""
WITH codes AS (SELECT l_orderkey, list(l_partkey % 25 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS codes FROM lineitem GROUP BY l_orderkey),
held AS (SELECT o_orderkey, 'NATION_' || (o_custkey % 25) AS detected, codes FROM orders JOIN codes ON o_orderkey = l_orderkey),
names AS (SELECT map_from_entries(list((n_nationkey::BIGINT, n_name))) AS m FROM nation)
SELECT o_orderkey, detected, {condition} AS valid FROM held, names
"""


ORACLE_SQL = {
    "dominant_label": """
WITH c AS (
  SELECT user_id, event_type, count(*) AS n, min((ts, event_id)) AS f FROM events WHERE value > 20 GROUP BY ALL
), r AS (
  SELECT user_id, event_type, n, sum(n) OVER (PARTITION BY user_id)::BIGINT AS total,
         row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS k FROM c
)
SELECT user_id, event_type, n, total, n / total >= 0.1 AS is_dominant FROM r WHERE k = 1
""",
    "most_confident_event": """
SELECT user_id, event_id, event_type, value FROM events WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) = 1
""",
    "no_label_filter": "SELECT doc_id, lang, source FROM documents ANTI JOIN labels USING (doc_id)",
    "no_label_predicate": """
SELECT p_partkey FROM part WHERE p_size % 3 = 0 AND p_size % 5 <> 0 AND p_size % 2 = 0 AND p_partkey % 7 <> 0
""",
    "half_sample_split": f"""
WITH plain AS (SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY {_key("42", "doc_id")}, doc_id) AS k, count(*) OVER () AS n FROM plain)
SELECT doc_id, CASE WHEN k <= n // 2 THEN 'noise' ELSE 'test' END AS part FROM r
""",
    "key_blocklist": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (1, 7, 1757)",
    "duration_filter": "SELECT doc_id, n_chars / 16.0::DOUBLE AS duration_s FROM documents WHERE n_chars / 16.0::DOUBLE >= 100",
    "code_lookup_join": """
SELECT c_custkey, n_nationkey::VARCHAR AS code, n_name AS name FROM customer JOIN nation ON c_nationkey::VARCHAR = n_nationkey::VARCHAR
""",
    "taxonomy_ci_first_match": """
WITH t AS (
  SELECT 'n_' || right(n_name, 1) AS code, n_nationkey, replace(lower(trim(r_name)), ' ', '_') AS common_name,
         replace(lower(trim(n_name || ' ' || r_name)), ' ', '_') AS scientific_name
  FROM nation JOIN region ON n_regionkey = r_regionkey
  QUALIFY row_number() OVER (PARTITION BY right(n_name, 1) ORDER BY n_nationkey) = 1
)
SELECT n.n_nationkey AS birdset_code, code AS ebird_code, common_name, scientific_name
FROM nation n JOIN t ON code = 'n_' || right(n.n_name, 1)
""",
    "label_membership_first": _membership("coalesce(m[codes[1]] = detected, false)"),
    "label_membership_any": _membership("len(list_filter(codes, lambda c: m[c] = detected)) > 0"),
    "normalize_name": "SELECT p_partkey, replace(lower(p_name), ' ', '_') AS name FROM part",
    "basename": r"""
SELECT page_id, base, stem, 'out/' || stem || '_' || page_id || '.wav' AS path FROM (
  SELECT page_id, base, CASE WHEN regexp_matches(base, '^.+\.[^.]*$') THEN regexp_extract(base, '^(.+)\.[^.]*$', 1) ELSE base END AS stem
  FROM (SELECT page_id, string_split(url, '/')[-1] AS base FROM pages))
""",
    "label_concat": "SELECT p_partkey, p_type || ', ' || p_brand AS label FROM part",
    "interval_semi": """
SELECT c.event_id, c.user_id FROM events c WHERE c.event_type = 'click' AND EXISTS (
  SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.user_id = c.user_id
  AND c.ts + INTERVAL 1 HOUR > e.ts AND c.ts < e.ts + INTERVAL 1 HOUR)
""",
    "interval_clip": """
WITH r AS (
  SELECT event_id, epoch_us(ts) / 1e6 - floor(epoch_us(ts) / 1e6 / 86400) * 86400 AS s,
         epoch_us(ts + INTERVAL 1 HOUR) / 1e6 - floor(epoch_us(ts) / 1e6 / 86400) * 86400 AS e FROM events
), b AS (SELECT *, unnest(range(floor(s / 3600)::BIGINT, floor(e / 3600)::BIGINT + 1)) AS hour FROM r)
SELECT event_id, hour, round(greatest(s, hour * 3600.0) - hour * 3600.0, 3) AS rel_start,
       round(least(e, hour * 3600.0 + 3600.0) - hour * 3600.0, 3) AS rel_end
FROM b WHERE e > hour * 3600.0 AND s < hour * 3600.0 + 3600.0
""",
    "only_target_in_window": """
WITH b AS (
  SELECT *, unnest(range(epoch_us(ts) // 43200000000, (epoch_us(ts) + 3600000000 - 1) // 43200000000 + 1)) AS w FROM events
), t AS (SELECT *, first_value(event_type) OVER (PARTITION BY user_id, w ORDER BY ts, event_id) AS target FROM b)
SELECT user_id, (w * 43200)::BIGINT AS window_start_s, target, count(*) AS n,
       bool_and(event_type = target OR value < 20) AS only_target FROM t GROUP BY user_id, w, target
""",
    "only_target_in_row": """
WITH t AS (SELECT *, first_value(l_returnflag) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS target FROM lineitem)
SELECT l_orderkey, count(*) FILTER (WHERE l_quantity > 5 AND l_quantity - 10 < 25) > 0
  AND coalesce(bool_and(l_discount < 0.02 OR l_returnflag = target) FILTER (WHERE l_quantity > 5 AND l_quantity - 10 < 25), true) AS only_target
FROM t GROUP BY l_orderkey
""",
    "shift_in_bounds": f"""
WITH m AS (SELECT event_id, minute(ts) * 60.0::DOUBLE AS s, ({_draw("42", "7201", "event_id")} - 3600)::DOUBLE AS shift FROM events)
SELECT event_id, shift, 3600.0 > s + shift AND 0.0 < s + 300 + shift AS inside FROM m
""",
    "dedupe_first_per_species": """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
""",
    "gap_merge_events": """
WITH g AS (
  SELECT user_id, event_id, epoch_us(ts) AS s, epoch_us(ts) + 3600000000 AS e,
         epoch_us(ts) - lag(epoch_us(ts) + 3600000000) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 21600000000 AS new FROM events
), i AS (SELECT *, sum(coalesce(new, false)::INT) OVER (PARTITION BY user_id ORDER BY s, event_id) AS k FROM g)
SELECT user_id, min(s) AS start_us, arg_max(e, (s, event_id)) AS end_us, count(*) AS n FROM i GROUP BY user_id, k
HAVING arg_max(e, (s, event_id)) - min(s) >= 3600000000
""",
    "merge_gaps_in_row": """
WITH g AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS n, l_quantity - 10 AS s, l_quantity AS e,
         l_quantity - 10 - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) > 0 AS new FROM lineitem
), i AS (SELECT *, sum(coalesce(new, false)::INT) OVER (PARTITION BY l_orderkey ORDER BY n) AS k FROM g
), m AS (SELECT l_orderkey, k, arg_min(s, n) AS s, arg_max(e, n) AS e FROM i GROUP BY l_orderkey, k)
SELECT l_orderkey, count(*)::INTEGER AS n, arg_min(s, (-(e - s), k)) AS longest_start, arg_min(e, (-(e - s), k)) AS longest_end
FROM m GROUP BY l_orderkey
""",
    "longest_event": """
SELECT user_id, event_id, round(value * 1e6)::BIGINT / 1e6 AS duration_s FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(value * 1e6) DESC, ts, event_id) = 1
""",
    "species_counts_having": "SELECT source, count(*) AS n, count(*) < 50 AS removed FROM documents GROUP BY source",
    "balance_under": f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {_key("42", "doc_id")}, doc_id) AS k FROM documents)
SELECT doc_id, lang FROM r WHERE k <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))
""",
    "balance_over": f"""
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM documents),
c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
d AS (SELECT lang, n, unnest(range(0, (SELECT max(n) FROM c))) AS draw FROM c)
SELECT d.lang, draw, doc_id FROM d JOIN r ON r.lang = d.lang AND r.k = {_draw("42", "n", "d.lang", "draw")} + 1
""",
    "balance_controlled": f"""
WITH f AS (
  SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY {_key("42", "doc_id")}, doc_id) <= 6
), p AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {_key("43", "doc_id")}, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM f
), w AS (SELECT lang, n, unnest(range(0, 100)) AS draw FROM (SELECT DISTINCT lang, n FROM p WHERE n < 100))
SELECT lang, k - 1 AS draw, doc_id FROM p WHERE n >= 100 AND k <= 100
UNION ALL
SELECT w.lang, draw, doc_id FROM w JOIN p ON p.lang = w.lang AND p.k = {_draw("42", "w.n", "w.lang", "draw")} + 1
""",
    "split_80_10_10": f"SELECT doc_id, {_SPLIT_NAME} FROM ({_SPLIT})",
    "split_sizes": f"""
SELECT split, count(*) AS n, count(DISTINCT source) AS n_files FROM (SELECT *, {_SPLIT_NAME} FROM ({_SPLIT})) GROUP BY ROLLUP (split)
""",
    "split_overlap_check": f"""
SELECT source, count(DISTINCT split) AS n_splits FROM (SELECT *, {_SPLIT_NAME} FROM ({_SPLIT})) GROUP BY source HAVING count(DISTINCT split) > 1
""",
    "split_by_file": f"""
SELECT doc_id, CASE WHEN d < 0.1 THEN 'test' WHEN d < 0.2 THEN 'validation' ELSE 'train' END AS split
FROM (SELECT doc_id, {_draw("42", "1000000", "source")} / 1000000 AS d FROM documents)
""",
    "replicate_shuffle": f"""
SELECT doc_id, epoch::INTEGER AS epoch, row_number() OVER (ORDER BY epoch, {_key("42 + epoch", "doc_id")}, doc_id) - 1 AS position
FROM documents, (SELECT unnest(range(0, 5)) AS epoch)
""",
    "batch_index": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch_idx FROM documents",
    "noise_pairing": f"""
WITH b AS (SELECT DISTINCT (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch_idx FROM documents),
m AS (SELECT batch_idx, unnest(range(0, 30)) AS mix_idx FROM b),
p AS (SELECT vec_id, row_number() OVER (ORDER BY {_key("42", "vec_id")}, vec_id) - 1 AS noise_idx FROM embeddings)
SELECT batch_idx, mix_idx::INTEGER AS mix_idx, noise_idx, vec_id
FROM m JOIN p ON noise_idx = batch_idx % ((SELECT count(*) FROM embeddings) // 30) * 30 + mix_idx
""",
    "flatten_members": """
SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS raw_files_l_partkey, list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS raw_files_l_quantity,
       list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS raw_files_l_returnflag FROM lineitem GROUP BY l_orderkey
""",
    "dataset_fingerprint": """
SELECT count(*) AS num_rows, """ + _fingerprint("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority") + """ AS fingerprint FROM orders
""",
    "clip_rms": f"SELECT vec_id, round({_RMS.format('x')}, 6) AS rms FROM {_X}",
    "rms_with_bounds": f"""
WITH t AS (SELECT vec_id, label, x, label / 8.0 AS t FROM {_X}),
c AS (SELECT vec_id, CASE WHEN label > 0 THEN list_concat(
        x[floor((t + 0.1) * 16)::INT + 1 : least(ceil((t + 1.3) * 16), len(x))::INT],
        x[floor((t + 1.0) * 16)::INT + 1 : least(ceil((t + 1.9) * 16), len(x))::INT]) ELSE x END AS c FROM t)
SELECT vec_id, round({_RMS.format('c')}, 6) AS rms FROM c
""",
    "peak_normalize": f"""
WITH t AS (SELECT vec_id, list_transform(x, lambda v: v * 4.0) AS x FROM {_X}),
p AS (SELECT *, greatest(abs(list_max(x)), abs(list_min(x))) AS p FROM t)
SELECT vec_id, round(p, 6) AS peak, CASE WHEN p > 1 THEN list_transform(x, lambda v: round(v * (1 / p), 6) + 0.0) ELSE {_rounded('x')} END AS samples FROM p
""",
    "dbfs_gain_roundtrip": """
SELECT event_id, round(pow(10.0, (value / 10 - 30) / 20.0), 6) AS gain,
       round(20.0 * log10(pow(10.0::DOUBLE, (value / 10 - 30) / 20.0)), 6) AS dbfs FROM events
""",
    "normalize_dbfs": f"""
WITH g AS (SELECT vec_id, x, pow(10.0::DOUBLE, -12.0 / 20.0) / ({_RMS.format('x')}) AS g FROM {_X})
SELECT vec_id, round(g, 6) AS gain, list_transform(x, lambda v: round(v * g, 5) + 0.0) AS samples FROM g
""",
    "pad_or_trim": f"""
WITH c AS (SELECT vec_id, x[1 : label * 8 + 8] AS c FROM {_X})
SELECT vec_id, list_concat({_rounded('c[1:48]')}, {_zeros('48 - len(c)')}) AS samples FROM c
""",
    "tumbling_segments": f"""
WITH c AS (SELECT vec_id, x, unnest([0, 20, 40, 60]) AS start FROM {_X})
SELECT vec_id, start // 20 AS segment, start, least(start + 20, len(x))::INTEGER AS "end",
       list_concat({_rounded('x[start + 1 : start + 20]')}, {_zeros('start + 20 - len(x)')}) AS samples
FROM c WHERE least(start + 20, len(x)) - start >= 4
""",
    "sliding_energy_argmax": f"""
WITH c AS (SELECT vec_id, x, unnest(range(0, 49, 4)) AS s FROM {_X}),
e AS (SELECT vec_id, s, round(list_sum(list_transform(x[s + 1 : s + 16], lambda v: v * v)), 9) AS e FROM c)
SELECT vec_id, s::INTEGER AS start, round(e, 6) AS energy FROM e QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY e DESC, s) = 1
""",
    "moving_average_same": f"""
SELECT vec_id, list_transform(range(0, 64), lambda i: round(list_sum(x[greatest(i - 1, 1) : least(i + 3, 64)]) / 5, 6) + 0.0) AS samples FROM {_X}
""",
    "threshold_islands": f"""
WITH m AS (SELECT vec_id, generate_subscripts(x, 1) - 1 AS i, unnest(x) > 0.1 * list_max(x) AS m FROM {_X}),
e AS (SELECT *, coalesce(lag(m) OVER (PARTITION BY vec_id ORDER BY i), false) AS before FROM m),
k AS (SELECT *, sum((m <> before)::INT) OVER (PARTITION BY vec_id ORDER BY i) AS k FROM e)
SELECT vec_id, (row_number() OVER (PARTITION BY vec_id ORDER BY k) - 1)::INTEGER AS island, min(i)::INTEGER AS start, least(max(i) + 1, 63)::INTEGER AS "end"
FROM k WHERE m GROUP BY vec_id, k
""",
    "time_shift": f"""
WITH s AS (SELECT vec_id, x, ({_draw("42", "25", "vec_id")} - 12)::INTEGER AS moved FROM {_X})
SELECT vec_id, moved, list_concat(list_concat({_zeros('moved')}, {_rounded('x[greatest(-moved, 0) + 1 : 64 - greatest(moved, 0)]')}), {_zeros('-moved')}) AS samples FROM s
""",
    "silence_outside": f"""
SELECT vec_id, list_transform(x, lambda v, i: CASE WHEN (i - 1 >= 8 AND i - 1 < 16) OR (i - 1 >= label / 4.0 * 16 AND i - 1 < 48)
       THEN round(v, 6) + 0.0 ELSE 0.0 END) AS samples FROM {_X}
""",
    "area_of_interest": """
WITH t AS (SELECT vec_id, CASE WHEN label % 3 <> 0 THEN label * 5 END AS s, CASE WHEN label % 4 <> 0 THEN label * 5 + 20 END AS e FROM embeddings),
a AS (SELECT *, CASE WHEN s IS NULL AND e IS NULL THEN 0 WHEN s IS NULL THEN greatest(e - 32, 0) WHEN e IS NULL OR e - s >= 32 THEN s
      ELSE greatest(s - (32 - (e - s)) // 2, 0) END AS low FROM t)
SELECT vec_id, low::INTEGER AS start, (CASE WHEN s IS NULL AND e IS NOT NULL THEN least(greatest(e, 32), 64) ELSE least(low + 32, 64) END)::INTEGER AS "end" FROM a
""",
    "elementwise_mix": f"""
WITH l AS (SELECT label, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM {_X}),
s AS (SELECT label, i, round(sum(v), 4) AS v FROM l GROUP BY label, i)
SELECT label, list(v ORDER BY i) AS x FROM s GROUP BY label
""",
    "event_envelope": f"""
SELECT vec_id, 65 AS n_frames, list_transform(range(0, 65), lambda i: round(sqrt(list_sum(list_transform(x[greatest(i - 1, 1) : least(i + 2, 64)], lambda v: v * v)) / 4), 6) + 0.0) AS envelope
FROM {_X}
""",
    "event_bounds": f"""
WITH e AS (
  SELECT vec_id, list_transform(range(0, 65), lambda i: sqrt(list_sum(list_transform(x[greatest(i - 1, 1) : least(i + 2, 64)], lambda v: v * v)) / 4)) AS e FROM {_X}
), l AS (
  SELECT vec_id, list_transform(range(0, 65), lambda i: (e[i + 1] + CASE WHEN i > 0 THEN e[i] ELSE 0 END) / 2) AS l FROM e
), m AS (SELECT vec_id, generate_subscripts(l, 1) - 1 AS i, unnest(l) > 0.5 * list_max(l) AS m FROM l),
c AS (SELECT *, coalesce(lag(m) OVER (PARTITION BY vec_id ORDER BY i), false) AS before FROM m),
k AS (SELECT *, sum((m <> before)::INT) OVER (PARTITION BY vec_id ORDER BY i) AS k FROM c),
r AS (SELECT vec_id, min(i) AS s, least(max(i) + 1, 64) AS e FROM k WHERE m GROUP BY vec_id, k),
g AS (SELECT *, coalesce((s - lag(e) OVER (PARTITION BY vec_id ORDER BY s)) / 16.0 > 0.1, true) AS new FROM r),
n AS (SELECT *, sum(new::INT) OVER (PARTITION BY vec_id ORDER BY s) AS n FROM g),
o AS (SELECT vec_id, min(s) AS s, max(e) AS e FROM n GROUP BY vec_id, n HAVING (max(e) - min(s)) / 16.0 >= 0.05)
SELECT vec_id, (row_number() OVER (PARTITION BY vec_id ORDER BY s) - 1)::INTEGER AS event, s / 16.0::DOUBLE AS start, e / 16.0::DOUBLE AS "end" FROM o
""",
    "resample": f"""
WITH h AS (
  SELECT list(h ORDER BY m) AS h FROM (
    SELECT m, list((1 + 2 * list_sum(list_transform(range(1, 33), lambda k: cos(2 * pi() * k * (m / 96.0::DOUBLE - n / 64.0::DOUBLE))))) / 64 ORDER BY n) AS h
    FROM (SELECT unnest(range(96)) AS m), (SELECT unnest(range(64)) AS n) GROUP BY m)
)
SELECT vec_id, list_transform(h, lambda w: round(list_inner_product(w, x), 6) + 0.0) AS resampled FROM {_X}, h
""",
    "encode_wav": f"""
WITH p AS (SELECT vec_id, x, greatest(list_max(x), -list_min(x)) AS p FROM {_X}),
i AS (SELECT vec_id, list_transform(x, lambda v: (round_even(greatest(-1, least(1, CASE WHEN p > 1 THEN v / p ELSE v END)) * 32767, 0)::INTEGER + 65536) % 65536) AS i FROM p)
SELECT vec_id, 172 AS n_bytes, sha256(
  '52494646a400000057415645666d7420100000000100010010000000200000000200100064617461' || '80000000' ||
  list_aggregate(list_transform(i, lambda u: printf('%02x%02x', u % 256, u // 256)), 'string_agg', '')) AS hex_sha256 FROM i
""",
    "validated_sources": """
WITH c AS (
  SELECT user_id, event_id % 4 AS source, event_type, count(*) AS n, min((ts, event_id)) AS f FROM events WHERE value > 20 GROUP BY ALL
), r AS (
  SELECT *, sum(n) OVER (PARTITION BY user_id, source)::BIGINT AS total, row_number() OVER (PARTITION BY user_id, source ORDER BY n DESC, f) AS k FROM c
), t AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS code FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL))
SELECT user_id AS recording_id, source AS source_idx, event_type AS name, code, n, total FROM r JOIN t USING (event_type)
WHERE k = 1 AND n / total >= 0.3 AND code IN (user_id % 5, (user_id + 2) % 5)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY n DESC, source) = 1
""",
    "segment_windows": f"""
WITH w AS (SELECT vec_id, x, label, label / 4.0::DOUBLE AS t, unnest([0, 16, 32, 48]) AS s FROM {_X}),
v AS (SELECT *, s / 16.0::DOUBLE AS a, s / 16.0::DOUBLE + 1 AS b FROM w)
SELECT vec_id, (s // 16)::INTEGER AS segment, s AS start, s + 16 AS "end", {_rounded('x[s + 1 : s + 16]')} AS samples,
       list_concat(CASE WHEN b > 0.5 AND a < 1.0 THEN [greatest(0.5, a) - a, least(1.0, b) - a, 1.0, 4.0] ELSE [] END::DOUBLE[],
                   CASE WHEN b > t AND a < t + 1.25 THEN [greatest(t, a) - a, least(t + 1.25, b) - a, 1.0, 4.0] ELSE [] END::DOUBLE[]) AS bounds
FROM v WHERE ((b > 0.5 AND a < 1.0) OR (b > t AND a < t + 1.25))
  AND ((b > 0.25 AND a < 3.5) OR (b > t AND a < t + 0.5)) AND NOT (label % 2 <> 0 AND b > t AND a < t + 0.5)
""",
    "truncated": f"""
WITH r AS (
  SELECT vec_id, x, CASE WHEN label % 3 = 1 THEN round(label / 4.0 * 16)::INT END AS s, CASE WHEN label % 4 = 1 THEN round((label / 4.0 + 0.5) * 16)::INT END AS e FROM {_X}
), l AS (
  SELECT *, list_transform(range(0, 33, 16), lambda i: round(list_sum(list_transform(x[i + 1 : i + 32], lambda v: v * v)), 9)) AS energy FROM r
), a AS (
  SELECT *, CASE WHEN s IS NULL AND e IS NULL THEN (list_position(energy, list_max(energy)) - 1) * 16 WHEN s IS NULL THEN greatest(e - 32, 0)
       WHEN e IS NULL OR e - s >= 32 THEN s ELSE greatest(s - (32 - (e - s)) // 2, 0) END AS low FROM l
)
SELECT vec_id, {_rounded('x[low + 1 : CASE WHEN s IS NULL AND e IS NOT NULL THEN least(greatest(e, 32), 64) ELSE least(low + 32, 64) END]')} AS samples FROM a
""",
    "long_signals": "SELECT vec_id, least(label * 8 + 8, 64)::INTEGER AS n FROM embeddings WHERE least(label * 8 + 8, 64) >= 32",
    "mono_float": f"SELECT vec_id, list_transform(range(1, 33), lambda i: ((x[i] + x[i + 32]) / 2)::FLOAT::DOUBLE) AS mono FROM {_X}",
    "smoothed": f"""
SELECT vec_id, list_transform(range(0, 64), lambda i: round(list_sum(list_transform(range(i - 2, i + 3),
       lambda j: x[CASE WHEN j < 0 THEN -j WHEN j > 63 THEN 128 - j ELSE j + 1 END])) / 5, 6) + 0.0) AS smooth FROM {_X}
""",
    "weighted_percentiles": f"""
WITH w AS (SELECT vec_id, list_transform(x, lambda v: abs(v)) AS w FROM {_X}),
c AS (SELECT vec_id, list_transform(range(1, 65), lambda i: list_sum(w[1 : i]) / list_sum(w)) AS c FROM w),
p AS (SELECT vec_id, c, unnest([0.05, 0.95]) AS p FROM c),
i AS (SELECT *, len(list_filter(c, lambda v: v <= p)) AS i FROM p)
SELECT vec_id, min(spot) AS low, max(spot) AS high FROM (
  SELECT vec_id, round(CASE WHEN i = 0 THEN 0 ELSE (i - 1) / 4.0 + 0.25 * (p - c[i]) / (c[i + 1] - c[i]) END, 6) AS spot FROM i) GROUP BY vec_id
""",
    "same_species": "SELECT p_partkey, p_size % 3 = 1 OR (p_size % 3 = 2 AND lower(replace(p_type, ' ', '_')) = lower(replace(p_brand, ' ', '_'))) AS same FROM part",
    "removed_classes": """
WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY source)
SELECT source, CASE WHEN n >= 60 THEN (SELECT min(n) FROM c WHERE n >= 60) ELSE n END AS n, n < 60 AS removed FROM c
""",
    "noise_and_test": f"""
WITH plain AS (SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY {_key("42", "doc_id")}, doc_id) AS k, count(*) OVER () AS n FROM plain)
SELECT doc_id, CASE WHEN k <= n // 2 THEN 'noise' ELSE 'test' END AS part FROM documents LEFT JOIN r USING (doc_id)
""",
    "flattened_schema": """
SELECT * FROM (VALUES
  (0, 'raw_files_segment_id', 'array<string>'), (1, 'raw_files_audio_array', 'array<array<float>>'), (2, 'raw_files_audio_sampling_rate', 'array<bigint>'),
  (3, 'raw_files_time_freq_bounds', 'array<array<array<float>>>'), (4, 'raw_files_birdset_code', 'array<bigint>'), (5, 'raw_files_ebird_code', 'array<string>'),
  (6, 'raw_files_scientific_name', 'array<string>'), (7, 'raw_files_common_name', 'array<string>'),
  (8, 'raw_files_original_birdset_subset', 'array<string>'), (9, 'raw_files_original_file', 'array<string>')) t(position, name, type)
""",
    "first_rows": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100",
    "empty_column": "SELECT doc_id, source, 0 AS n_detections, true AS no_name FROM documents",
    "forced_schema": "SELECT n_nationkey, n_name, NULL::VARCHAR AS n_code FROM nation",
    "split_sink": """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN r <= n - ceil(round(n * 0.1, 9)) THEN 'train' ELSE 'test' END AS split FROM r WHERE doc_id % 3 <> 0
""",
    "published_manifest": f"""
WITH s AS (SELECT doc_id, lang, {_SPLIT_NAME} FROM ({_SPLIT}))
SELECT count(*) AS num_rows, {_fingerprint("doc_id", "lang", "split")} AS fingerprint, 'doc_id,lang,source,split' AS columns, 'bigint' AS doc_id_type FROM s
""",
    "code_map_file": """
SELECT 'HSN' AS subset, n_nationkey AS birdset_code, lower(n_name) AS ebird_code, replace(lower(n_name || ' bird'), ' ', '_') AS common_name,
       replace(lower('Avis ' || n_name), ' ', '_') AS scientific_name FROM nation
""",
    "stream_tumbling": """
SELECT user_id, epoch_us(ts) // 43200000000 * 43200000000 AS start_us, epoch_us(ts) // 43200000000 * 43200000000 + 43200000000 AS end_us,
       count(*) AS n, max(value) AS most FROM events GROUP BY ALL
""",
    "stream_sliding": """
WITH w AS (SELECT user_id, value, epoch_us(ts) // 21600000000 * 21600000000 - unnest([0, 21600000000]) AS start_us FROM events)
SELECT user_id, start_us, start_us + 43200000000 AS end_us, count(*) AS n, max(value) AS most FROM w GROUP BY user_id, start_us
""",
    "stream_sessions": """
WITH g AS (SELECT user_id, epoch_us(ts) AS t, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= 21600000000, true) AS new, event_id FROM events),
k AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY t, event_id) AS k FROM g)
SELECT user_id, min(t) AS start_us, max(t) + 21600000000 AS end_us, count(*) AS n FROM k GROUP BY user_id, k
""",
    "stream_totals": "SELECT user_id, count(value) AS n, round(sum(value), 4) AS total FROM events GROUP BY user_id",
    "fake_separate": f"""
WITH h AS (
  SELECT source_idx, list(h ORDER BY n) AS h FROM (
    SELECT source_idx, n, list(list_sum(list_transform(range(low, high), lambda k: CASE WHEN k IN (0, 32) THEN 1 ELSE 2 END * cos(2 * pi() * k * (n - m) / 64))) / 64 ORDER BY m) AS h
    FROM (VALUES (0, 0, 8), (1, 8, 16), (2, 16, 24), (3, 24, 33)) b(source_idx, low, high), (SELECT unnest(range(64)) AS n), (SELECT unnest(range(64)) AS m)
    GROUP BY source_idx, n) GROUP BY source_idx
)
SELECT vec_id, source_idx, list_transform(h, lambda w: round(list_inner_product(w, x)::FLOAT::DOUBLE, 5) + 0.0) AS signal FROM {_X}, h
""",
}
