"""DuckDB SQL for every SQL-checkable query key (same column names as the Spark side).

Regex texts are shared with the Spark expressions: they are written in the subset
Java regex and RE2 read alike.
"""

from __future__ import annotations

from sheen.functions.constants import CATEGORY_IDS, CATEGORY_NAMES, TRAITS
from sheen.functions.parse import TRAIT_SPLIT_RE
from sheen.functions.text import STRIP_RE
from sheen.sources.fixtures import with_fx

SQL: dict[str, str] = {}


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(STRIP_RE)}, '', 'g')"


def split_strip(x: str) -> str:
    return f"list_transform(string_split({x}, ','), lambda p: {strip('p')})"


CHARS = f"list_filter(regexp_split_to_array(chars, {lit(TRAIT_SPLIT_RE)}), lambda x: x <> '')"

CLEAN_CTE = f"""clean_fx AS (
  SELECT pro_ids, names, CAST(ratings AS DOUBLE) AS ratings,
         CAST(replace(repurchases, '% would repurchase', '') AS DOUBLE) / CAST(100 AS DOUBLE) AS repurchases,
         CAST(replace(pkg_quals, 'Package Quality: ', '') AS DOUBLE) AS pkg_quals,
         CAST(length(replace(prices, 'Price: ', '')) AS INTEGER) AS prices,
         coalesce(nullif(ingredients, ''), 'nan') AS ingredients,
         brands, brand_ids, {strip('users')} AS users, chars_a AS chars, {strip('reviews')} AS reviews,
         CAST(substr(lipies, 3, 1) AS INTEGER) AS lipies,
         CAST(strptime(regexp_extract({strip('dates')}, '(\\d+/\\d+/\\d+)', 1), '%m/%d/%Y') AS DATE) AS dates,
         chars_a[1] AS age, skin_a AS skin, hair_a AS hair, chars_a[4] AS eyes,
         skin_a[1] AS skin_type, skin_a[2] AS skin_tone, skin_a[3] AS skin_undertone,
         hair_a[1] AS hair_color, hair_a[2] AS hair_type, hair_a[3] AS hair_texture,
         cat_id
  FROM (SELECT *, {split_strip('chars_a[2]')} AS skin_a, {split_strip('chars_a[3]')} AS hair_a
        FROM (SELECT *, {CHARS} AS chars_a FROM reviews_raw_fx)))"""

UID_CTE = """uid_fx AS (
  SELECT users, CAST(row_number() OVER (ORDER BY users) - 1 AS BIGINT) AS uid
  FROM (SELECT DISTINCT users FROM clean_fx))"""


def clean_sql(body: str, extra: list[str] | None = None, fx: list[str] | None = None) -> str:
    return with_fx(["reviews_raw_fx"] + (fx or []), [CLEAN_CTE] + (extra or [])) + body


def raw_sql(body: str) -> str:
    return with_fx(["reviews_raw_fx"]) + body


# ----------------------------------------------------------------------------- §2.3
SQL["clean_ratings"] = raw_sql("SELECT pro_ids, CAST(ratings AS DOUBLE) AS ratings FROM reviews_raw_fx")
SQL["clean_repurchases"] = raw_sql(
    "SELECT pro_ids, CAST(replace(repurchases, '% would repurchase', '') AS DOUBLE) "
    "/ CAST(100 AS DOUBLE) AS repurchases FROM reviews_raw_fx")
SQL["clean_pkg_quals"] = raw_sql(
    "SELECT pro_ids, CAST(replace(pkg_quals, 'Package Quality: ', '') AS DOUBLE) AS pkg_quals "
    "FROM reviews_raw_fx")
SQL["clean_prices"] = raw_sql(
    "SELECT pro_ids, CAST(length(replace(prices, 'Price: ', '')) AS INTEGER) AS prices "
    "FROM reviews_raw_fx")
SQL["split_traits"] = raw_sql(
    f"SELECT users, array_to_string({CHARS}, '|') AS chars, CAST(len({CHARS}) AS INTEGER) AS n_parts "
    "FROM reviews_raw_fx")
SQL["strip_text"] = raw_sql(
    f"SELECT {strip('users')} AS users, {strip('reviews')} AS reviews, {strip('dates')} AS dates "
    "FROM reviews_raw_fx")
SQL["clean_lipies"] = raw_sql(
    "SELECT pro_ids, CAST(substr(lipies, 3, 1) AS INTEGER) AS lipies FROM reviews_raw_fx")
SQL["parse_dates"] = clean_sql("SELECT pro_ids, users, dates FROM clean_fx")
SQL["format_month"] = clean_sql("SELECT pro_ids, users, strftime(dates, '%b-%Y') AS month FROM clean_fx")
SQL["traits_to_columns"] = clean_sql(
    "SELECT users, age, array_to_string(skin, '|') AS skin, array_to_string(hair, '|') AS hair, eyes "
    "FROM clean_fx")
SQL["split_strip_lists"] = clean_sql(
    "SELECT users, array_to_string(skin, '|') AS skin, CAST(len(skin) AS INTEGER) AS n_skin, "
    "array_to_string(hair, '|') AS hair, CAST(len(hair) AS INTEGER) AS n_hair FROM clean_fx")
SQL["lists_to_columns"] = clean_sql(
    "SELECT users, skin_type, skin_tone, skin_undertone, hair_color, hair_type, hair_texture "
    "FROM clean_fx")
SQL["ingredients_to_string"] = clean_sql("SELECT DISTINCT pro_ids, ingredients FROM clean_fx")
_CAT_CASE = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in zip(CATEGORY_IDS, CATEGORY_NAMES))
SQL["category_name"] = clean_sql(
    f"SELECT pro_ids, cat_id, CASE cat_id {_CAT_CASE} END AS category FROM clean_fx")
_PROFILE_COLS = ["pro_ids", "names", "ratings", "ingredients", "users", "lipies", "dates"]
SQL["profile_table"] = clean_sql(
    "SELECT count(*) AS n_rows, " + ", ".join(f"count({c}) AS nn_{c}" for c in _PROFILE_COLS)
    + ", count(DISTINCT pro_ids) AS n_distinct_pro_ids FROM clean_fx")
SQL["clean_reviews"] = clean_sql(
    "SELECT pro_ids, names, ratings, repurchases, pkg_quals, prices, brands, brand_ids, users, "
    "reviews, lipies, dates, cat_id, " + ", ".join(TRAITS) + " FROM clean_fx")
SQL["blank_to_null"] = raw_sql(
    "SELECT DISTINCT pro_ids, nullif(ingredients, '') IS NULL AS no_ingredients FROM reviews_raw_fx")

# ----------------------------------------------------------------------------- §2.4
SQL["project_columns"] = clean_sql("SELECT pro_ids, users, lipies FROM clean_fx")
SQL["distinct_users"] = clean_sql("SELECT DISTINCT users FROM clean_fx")
SQL["assign_uid"] = clean_sql("SELECT users, uid FROM uid_fx", [UID_CTE])
SQL["join_uid"] = clean_sql("SELECT pro_ids, uid, lipies FROM clean_fx JOIN uid_fx USING (users)",
                            [UID_CTE])
SQL["distinct_products"] = clean_sql(
    "SELECT DISTINCT names, pro_ids, ratings, repurchases, pkg_quals, prices, ingredients, brands "
    "FROM clean_fx")
SQL["key_products"] = clean_sql(
    "SELECT DISTINCT CAST(pro_ids AS BIGINT) AS pro_ids, names FROM (SELECT DISTINCT names, pro_ids, "
    "ratings, repurchases, pkg_quals, prices, ingredients, brands FROM clean_fx)")
SQL["distinct_traits"] = clean_sql(
    "SELECT DISTINCT " + ", ".join(TRAITS) + ", uid FROM clean_fx JOIN uid_fx USING (users)",
    [UID_CTE])
SQL["product_lookup"] = with_fx(["catalog_fx", "recs_fx"]) + (
    "SELECT pro_ids, names, brands, ratings, repurchases, pkg_quals, prices FROM catalog_fx "
    "WHERE pro_ids IN (SELECT CAST(rec1 AS INTEGER) FROM recs_fx)")
SQL["unique_counts"] = clean_sql(
    "SELECT 'users' AS what, count(DISTINCT users) AS n FROM clean_fx UNION ALL "
    "SELECT 'products', count(DISTINCT pro_ids) FROM clean_fx UNION ALL "
    "SELECT 'trait_rows', count(*) FROM (SELECT DISTINCT " + ", ".join(TRAITS)
    + ", uid FROM clean_fx JOIN uid_fx USING (users))", [UID_CTE])

SQL["unique_count_sketches"] = clean_sql(
    "SELECT 'users' AS what, count(DISTINCT users) AS n, TRUE AS within FROM clean_fx UNION ALL "
    "SELECT 'products', count(DISTINCT pro_ids), TRUE FROM clean_fx")

# ----------------------------------------------------------------------------- §2.8 (part)
_HIST = """SELECT names, CAST(lipies AS INTEGER) AS lipies, count(*) AS n
  FROM ratings_fx JOIN catalog_fx USING (pro_ids) GROUP BY names, CAST(lipies AS INTEGER)"""
SQL["rating_histogram"] = with_fx(["ratings_fx", "catalog_fx"]) + _HIST
SQL["histogram_series"] = with_fx(["ratings_fx", "catalog_fx"]) + (
    f"SELECT names, lipies AS x, n AS y FROM ({_HIST})")
SQL["product_options"] = with_fx(["catalog_fx"]) + (
    "SELECT pro_ids, names AS label, names AS value FROM catalog_fx")

# ----------------------------------------------------------------------------- §2.5
from sheen.functions.text import INGREDIENT_SPLIT_RE  # noqa: E402
from sheen.operators.ingredients import EDITS, PER_EDIT  # noqa: E402

_SPLIT = f"regexp_split_to_array(lower(coalesce(ingredients, '')), {lit(INGREDIENT_SPLIT_RE)})"
_STRIPPED = f"list_filter(list_transform({_SPLIT}, lambda t: {strip('lower(t)')}), lambda t: t <> '')"
_WATER = "CASE WHEN contains(t, 'water') AND NOT contains(t, 'water-binding') THEN 'water' ELSE t END"
_OIL = "CASE WHEN contains(t, ' oil') AND NOT contains(t, 'mineral oil') THEN 'oil' ELSE t END"
_EXTRACT = "CASE WHEN contains(t, ' extract') THEN 'extract' ELSE t END"
_TOKENS = (f"list_filter(list_transform(list_transform(list_transform({_STRIPPED}, lambda t: {_WATER}), "
           f"lambda t: {_OIL}), lambda t: {_EXTRACT}), lambda t: length(t) >= 4)")

TOKENS_CTE = f"toks AS (SELECT pro_ids, {_TOKENS} AS tokens FROM catalog_fx)"
VOCAB_CTE = """vocab AS (
  SELECT token, first_pro_ids, first_pos,
         CAST(row_number() OVER (ORDER BY first_pro_ids, first_pos) - 1 AS BIGINT) AS token_idx
  FROM (SELECT token, min(pro_ids) AS first_pro_ids, arg_min(pos, CAST(pro_ids AS BIGINT) * 100000000 + pos) AS first_pos
        FROM (SELECT pro_ids, unnest(tokens) AS token, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos
              FROM toks)
        GROUP BY token))"""
GROUPS_CTE = """grp AS (
  SELECT token, regexp_replace(token, '[aeiouy ]', '', 'g') AS "group" FROM vocab),
groups AS (
  SELECT g."group", token, exemplar FROM grp g
  JOIN (SELECT "group", min(token) AS exemplar FROM grp GROUP BY "group") e USING ("group"))"""


def tok_sql(body: str, extra: list[str] | None = None) -> str:
    return with_fx(["catalog_fx"], [TOKENS_CTE] + (extra or [])) + body


def _arr_sql(arr: str) -> str:
    return tok_sql(f"SELECT pro_ids, array_to_string({arr}, '|') AS tokens, "
                   f"CAST(len({arr}) AS INTEGER) AS n_tokens FROM catalog_fx")


SQL["split_ingredients"] = _arr_sql(_SPLIT)
SQL["strip_tokens"] = _arr_sql(_STRIPPED)
SQL["water_rule"] = _arr_sql(f"list_transform({_STRIPPED}, lambda t: {_WATER})")
SQL["oil_rule"] = _arr_sql(f"list_transform({_STRIPPED}, lambda t: {_OIL})")
SQL["extract_rule"] = _arr_sql(f"list_transform({_STRIPPED}, lambda t: {_EXTRACT})")
SQL["length_filter"] = _arr_sql(f"list_filter({_STRIPPED}, lambda t: length(t) > 3)")
SQL["ingredient_tokens"] = tok_sql(
    "SELECT pro_ids, array_to_string(tokens, '|') AS tokens, CAST(len(tokens) AS INTEGER) AS n_tokens FROM toks")
SQL["token_vocabulary"] = tok_sql("SELECT token, first_pro_ids, first_pos, token_idx FROM vocab", [VOCAB_CTE])

# DuckDB's levenshtein counts bytes; the eleven lower-case non-ASCII letters that occur
# in the documents are mapped to single control bytes first, so it counts characters.
_WIDE = "éóèñçüêäößí"
_NARROW = " || ".join(f"chr({i})" for i in [1, 2, 3, 4, 5, 6, 7, 8, 11, 12, 14])
# Two-letter sequences as 480 bits, an edit changing at most four, rule most pairs out before
# the brute-force distance; lengths meet by equality.
_WORDS = range(8)
_SKETCH = ", ".join(f"bit_xor(CASE WHEN g // 60 = {j} THEN (CAST(1 AS BIGINT) << (g % 60)) ELSE 0 END) AS s{j}" for j in _WORDS)
_DIFFER = " + ".join(f"bit_count(xor(a.s{j}, b.s{j}))" for j in _WORDS)
SQL["token_edit_distance"] = tok_sql(f"""SELECT token_a, token_b, dist, -dist AS similarity FROM (
  SELECT least(a.token, b.token) AS token_a, greatest(a.token, b.token) AS token_b, b.k,
         CAST(levenshtein(a.bt, b.bt) AS INTEGER) AS dist
  FROM v a JOIN (SELECT *, unnest(range(n - k, n + 1)) AS m FROM v) b ON a.n = b.m
  WHERE (b.n > a.n OR a.token < b.token) AND {_DIFFER} <= 4 * b.k) WHERE dist <= k""", [VOCAB_CTE, f"""w AS MATERIALIZED (
  SELECT token, translate(token, '{_WIDE}', {_NARROW}) AS bt, length(token) AS n,
         greatest({EDITS}, length(token) // {PER_EDIT}) AS k FROM vocab)""", f"""sketch AS (
  SELECT token, {_SKETCH} FROM (
    SELECT token, (ascii(substr(bt, p, 1)) * 31 + ascii(substr(bt, p + 1, 1))) % 480 AS g
    FROM (SELECT token, bt, unnest(range(1, n)) AS p FROM w)) GROUP BY token)""", """v AS MATERIALIZED (
  SELECT * FROM w JOIN sketch USING (token))"""])
SQL["group_lookup"] = tok_sql(
    'SELECT t.token, t.pro_ids, g."group" FROM (SELECT pro_ids, unnest(tokens) AS token FROM toks) t '
    "JOIN groups g USING (token)", [VOCAB_CTE, GROUPS_CTE])
SQL["group_members"] = tok_sql(
    'SELECT "group", exemplar, token, count(*) OVER (PARTITION BY "group") AS n_members FROM groups',
    [VOCAB_CTE, GROUPS_CTE])
SQL["product_groups"] = tok_sql(
    """SELECT pro_ids, array_to_string(list_sort(list("group")), '|') AS groups,
       CAST(count(*) AS INTEGER) AS n_groups
FROM (SELECT DISTINCT t.pro_ids, g."group" FROM (SELECT pro_ids, unnest(tokens) AS token FROM toks) t
      JOIN groups g USING (token)) GROUP BY pro_ids""", [VOCAB_CTE, GROUPS_CTE])

# ----------------------------------------------------------------------------- §2.6
from sheen.functions.constants import SLOT_OFFSETS, TRAIT_DOMAINS  # noqa: E402

PGROUPS_CTE = """pgroups AS (
  SELECT pro_ids, list_sort(list("group")) AS groups FROM (
    SELECT DISTINCT t.pro_ids, g."group" FROM (SELECT pro_ids, unnest(tokens) AS token FROM toks) t
    JOIN groups g USING (token)) GROUP BY pro_ids),
feat AS (
  SELECT c.pro_ids, c.names, c.ratings, c.repurchases, c.pkg_quals, c.prices,
         coalesce(pg.groups, CAST([] AS VARCHAR[])) AS groups, len(coalesce(pg.groups, CAST([] AS VARCHAR[]))) AS n_groups
  FROM catalog_fx c LEFT JOIN pgroups pg USING (pro_ids)),
qprod AS (
  SELECT r.req_id, r.product_name, min(c.pro_ids) AS pro_ids
  FROM requests_fx r JOIN catalog_fx c ON r.product_name = c.names GROUP BY r.req_id, r.product_name)"""

MULTIHOT_CTE = """mh AS (
  SELECT pro_ids, "group", CAST(dense_rank() OVER (ORDER BY "group") - 1 AS BIGINT) AS feature_idx, CAST(1.0 AS DOUBLE) AS value
  FROM (SELECT pro_ids, unnest(groups) AS "group" FROM pgroups))"""


def feat_sql(body: str, extra: list[str] | None = None, fx: list[str] | None = None) -> str:
    return with_fx(["catalog_fx", "requests_fx"] + (fx or []),
                   [TOKENS_CTE, VOCAB_CTE, GROUPS_CTE, PGROUPS_CTE] + (extra or [])) + body


SQL["multi_hot_groups"] = feat_sql('SELECT pro_ids, "group", feature_idx, value FROM mh', [MULTIHOT_CTE])
_NUM = ["ratings", "repurchases", "pkg_quals", "prices"]
SQL["assemble_features"] = feat_sql(
    'SELECT pro_ids, "group", feature_idx, value FROM mh UNION ALL '
    + " UNION ALL ".join(
        f"SELECT pro_ids, '{c}', CAST((SELECT coalesce(max(feature_idx) + 1, 0) FROM mh) + {j} AS BIGINT), "
        f"CAST({c} AS DOUBLE) FROM catalog_fx" for j, c in enumerate(_NUM)), [MULTIHOT_CTE])
SQL["product_vectors"] = ("SELECT pro_ids, feature_idx, value FROM (" + SQL["assemble_features"] + ") WHERE value <> 0")
SQL["feature_by_name"] = feat_sql("SELECT req_id, product_name, pro_ids FROM qprod")

_D2 = ("CAST(qf.n_groups + f.n_groups - 2 * len(list_intersect(qf.groups, f.groups)) AS DOUBLE)"
       + "".join(f" + (CAST(qf.{c} AS DOUBLE) - CAST(f.{c} AS DOUBLE)) * (CAST(qf.{c} AS DOUBLE) - CAST(f.{c} AS DOUBLE))"
                 for c in _NUM))
SQL["similar_products"] = feat_sql(f"""SELECT req_id, CAST(rank AS INTEGER) AS rank, pro_ids, dist2 FROM (
  SELECT q.req_id, f.pro_ids, {_D2} AS dist2,
         row_number() OVER (PARTITION BY q.req_id ORDER BY {_D2}, f.pro_ids) AS rank
  FROM qprod q JOIN feat qf ON qf.pro_ids = q.pro_ids JOIN feat f ON f.pro_ids <> q.pro_ids)
WHERE rank <= 10""")

_UNPIVOT_TRAITS = "UNPIVOT (value FOR trait IN (" + ", ".join(TRAITS) + "))"
_T_ORD = "CASE trait " + " ".join(f"WHEN '{t}' THEN {j}" for j, t in enumerate(TRAITS)) + " END"
ONEHOT_CTE = f"""tlong AS (SELECT uid, trait, value FROM traits_fx {_UNPIVOT_TRAITS}),
cats AS (SELECT trait, value, {_T_ORD} AS t_ord,
                row_number() OVER (PARTITION BY trait ORDER BY value) - 1 AS local
         FROM (SELECT DISTINCT trait, value FROM tlong)),
offs AS (SELECT t_ord, coalesce(sum(n) OVER (ORDER BY t_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
         FROM (SELECT t_ord, count(*) AS n FROM cats GROUP BY t_ord)),
slots AS (SELECT trait, value, CAST(off + local AS INTEGER) AS slot FROM cats JOIN offs USING (t_ord)),
onehot AS (SELECT uid, trait, value, slot FROM tlong JOIN slots USING (trait, value))"""
SQL["one_hot_traits"] = with_fx(["traits_fx"], [ONEHOT_CTE]) + "SELECT uid, trait, value, slot FROM onehot"
SQL["trait_vectors"] = with_fx(["traits_fx"], [ONEHOT_CTE]) + "SELECT uid, slot, CAST(1 AS DOUBLE) AS value FROM onehot"
SQL["feature_names"] = with_fx(["traits_fx"], [ONEHOT_CTE]) + (
    f"SELECT DISTINCT slot, 'x' || CAST({_T_ORD} AS VARCHAR) || '_' || value AS name FROM onehot")

_DOMAIN_ROWS = ", ".join(f"({lit(t)}, {lit(v)}, {SLOT_OFFSETS[t] + i})"
                         for t in TRAITS for i, v in enumerate(TRAIT_DOMAINS[t]))
DOMAINS_CTE = f"domains AS (SELECT * FROM (VALUES {_DOMAIN_ROWS}) AS d(trait, value, slot))"
SQL["trait_domains"] = with_fx(["traits_fx"], [DOMAINS_CTE]) + f"""SELECT d.trait, d.value, CAST(d.slot AS INTEGER) AS slot,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_users
FROM domains d LEFT JOIN (SELECT trait, value, count(*) AS n FROM (SELECT uid, trait, value FROM traits_fx {_UNPIVOT_TRAITS})
                          GROUP BY trait, value) c USING (trait, value)"""
SQL["request_vector"] = with_fx(["requests_fx"], [DOMAINS_CTE]) + (
    f"SELECT req_id, trait, CAST(slot AS INTEGER) AS slot FROM (SELECT req_id, trait, value FROM requests_fx "
    f"{_UNPIVOT_TRAITS}) JOIN domains USING (trait, value)")

_EVEN = ONEHOT_CTE.replace("FROM traits_fx", "FROM (SELECT * FROM traits_fx WHERE uid % 2 = 0)")
SQL["trait_vectors_of_requests"] = with_fx(["requests_fx", "traits_fx"], [_EVEN]) + (
    f"SELECT req_id, slot, CAST(1 AS DOUBLE) AS value FROM (SELECT req_id, trait, value FROM requests_fx {_UNPIVOT_TRAITS}) "
    "JOIN slots USING (trait, value)")

_MATCH = " + ".join(f"CASE WHEN r.{t} = t.{t} THEN 1 ELSE 0 END" for t in TRAITS)
_QSET = " + ".join(f"CASE WHEN r.{t} IS NOT NULL THEN 1 ELSE 0 END" for t in TRAITS)
_RSET = " + ".join(f"CASE WHEN t.{t} IS NOT NULL THEN 1 ELSE 0 END" for t in TRAITS)
SIMUSERS_CTE = f"""simusers AS (
  SELECT req_id, CAST(rank AS INTEGER) AS rank, uid, dist2 FROM (
    SELECT r.req_id, t.uid, CAST(({_QSET}) + ({_RSET}) - 2 * ({_MATCH}) AS DOUBLE) AS dist2,
           row_number() OVER (PARTITION BY r.req_id ORDER BY ({_QSET}) + ({_RSET}) - 2 * ({_MATCH}), t.uid) AS rank
    FROM requests_fx r CROSS JOIN traits_fx t)
  WHERE rank <= 10)"""
SQL["similar_users"] = with_fx(["requests_fx", "traits_fx"], [SIMUSERS_CTE]) + (
    "SELECT req_id, rank, uid, dist2 FROM simusers")

RM_CTE = "rm AS (SELECT pro_ids, uid, sum(lipies) AS value FROM ratings_fx GROUP BY pro_ids, uid)"
SQL["rating_matrix"] = with_fx(["ratings_fx"], [RM_CTE]) + "SELECT pro_ids, uid, value FROM rm"
SQL["rating_pivot"] = with_fx(["ratings_fx"]) + """SELECT pro_ids, (SELECT count(DISTINCT uid) FROM ratings_fx WHERE lipies IS NOT NULL) AS n_users,
  coalesce(string_agg(CAST(uid AS VARCHAR), '|' ORDER BY uid) FILTER (WHERE uid IS NOT NULL AND m IS NOT NULL), '') AS users,
  coalesce(string_agg(printf('%.6f', m), '|' ORDER BY uid) FILTER (WHERE uid IS NOT NULL AND m IS NOT NULL), '') AS means
  FROM (SELECT pro_ids, uid, avg(lipies) AS m FROM ratings_fx GROUP BY pro_ids, uid) GROUP BY pro_ids"""
SQL["max_abs_scale"] = with_fx(["ratings_fx"], [RM_CTE]) + (
    "SELECT pro_ids, uid, CASE WHEN m = 0 THEN 0.0 ELSE value / m END AS value FROM "
    "(SELECT pro_ids, uid, value, max(abs(value)) OVER (PARTITION BY uid) AS m FROM rm)")

UNIT_CTE = """unit AS (
  SELECT vec_id, label, list_transform(e, lambda x: CASE WHEN nrm = 0 THEN 0.0 ELSE x / nrm END) AS vec FROM (
    SELECT vec_id, label, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS nrm
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings))),
cscores AS (
  SELECT q.vec_id AS req_id, u.vec_id,
         list_reduce(list_transform(range(1, len(u.vec) + 1), lambda i: u.vec[i] * q.vec[i]), lambda a, b: a + b) AS score
  FROM unit q CROSS JOIN unit u WHERE q.vec_id % 20 = 0)"""
SQL["l2_normalize"] = f"WITH {UNIT_CTE}\n" + (
    "SELECT vec_id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS pos, round(unnest(vec), 9) AS value FROM unit")
SQL["name_factors"] = with_fx(["catalog_fx"], [UNIT_CTE]) + """SELECT vec_id, names, pos, round(value, 9) AS value FROM (
  SELECT vec_id, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS pos, unnest(vec) AS value FROM unit)
  LEFT JOIN catalog_fx ON CAST(pro_ids AS BIGINT) = vec_id"""
SQL["cosine_scores"] = f"WITH {UNIT_CTE}\n" + (
    "SELECT req_id, vec_id, round(score, 9) AS score FROM cscores")
SQL["cosine_top_k"] = f"WITH {UNIT_CTE}\n" + """SELECT req_id, vec_id, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT req_id, vec_id, score, row_number() OVER (PARTITION BY req_id ORDER BY score DESC, vec_id) AS rank
  FROM cscores WHERE vec_id <> req_id) WHERE rank <= 10"""
SQL["cosine_top_k_due"] = SQL["cosine_top_k"]

# ----------------------------------------------------------------------------- §2.7
SQL["als_rmse"] = with_fx(["ratings_fx"]) + """SELECT round(sqrt(avg((lipies - prediction) * (lipies - prediction))), 9) AS rmse
FROM ratings_fx JOIN (SELECT pro_ids, avg(lipies) AS prediction FROM ratings_fx GROUP BY pro_ids) USING (pro_ids)"""
SQL["recs_to_columns"] = with_fx(["recs_fx"]) + "SELECT * FROM recs_fx"

# ----------------------------------------------------------------------------- §2.8 hybrid
SIMPROD_CTE = f"""simprod AS (
  SELECT req_id, CAST(rank AS INTEGER) AS rank, pro_ids, dist2 FROM (
    SELECT q.req_id, f.pro_ids, {_D2} AS dist2,
           row_number() OVER (PARTITION BY q.req_id ORDER BY {_D2}, f.pro_ids) AS rank
    FROM qprod q JOIN feat qf ON qf.pro_ids = q.pro_ids JOIN feat f ON f.pro_ids <> q.pro_ids)
  WHERE rank <= 10)"""
_DET = "names, ratings, repurchases, pkg_quals, prices, brands"
SERVE_CTES = [TOKENS_CTE, VOCAB_CTE, GROUPS_CTE, PGROUPS_CTE, SIMUSERS_CTE, SIMPROD_CTE, f"""nrecs AS (
  SELECT s.req_id, s.rank, s.uid, r.rec1 FROM simusers s LEFT JOIN recs_fx r USING (uid)),
details AS (
  SELECT n.req_id, n.rank, n.uid, n.rec1, c.pro_ids, c.names, c.ratings, c.repurchases, c.pkg_quals,
         c.prices, c.brands
  FROM nrecs n LEFT JOIN catalog_fx c ON CAST(n.rec1 AS INTEGER) = c.pro_ids),
dedup AS (SELECT DISTINCT req_id, pro_ids, {_DET} FROM details),
content AS (
  SELECT s.req_id, s.rank, s.pro_ids, {", ".join("c." + x for x in _DET.split(", "))}
  FROM simprod s JOIN catalog_fx c USING (pro_ids)),
hybrid AS (
  SELECT req_id, pro_ids, {_DET}, 'users' AS half FROM dedup
  UNION ALL SELECT req_id, pro_ids, {_DET}, 'content' AS half FROM content),
picked AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY req_id ORDER BY
             md5(concat_ws('|', '123', CAST(req_id AS VARCHAR), CAST(coalesce(pro_ids, -1) AS VARCHAR), half)), half,
             pro_ids NULLS FIRST) AS INTEGER) AS pick
    FROM hybrid) WHERE pick <= 10)"""]


def serve_sql(body: str, extra: list[str] | None = None) -> str:
    return with_fx(["catalog_fx", "requests_fx", "traits_fx", "recs_fx"], SERVE_CTES + (extra or [])) + body


SQL["neighbor_recs"] = serve_sql("SELECT req_id, rank, uid, rec1 FROM nrecs")
SQL["rec_details"] = serve_sql("SELECT * FROM details")
SQL["rec_dedup"] = serve_sql("SELECT * FROM dedup")
SQL["content_recs"] = serve_sql("SELECT * FROM content")
SQL["hybrid_union"] = serve_sql("SELECT * FROM hybrid")
SQL["seeded_sample"] = serve_sql("SELECT * FROM picked")
UNKNOWN_CTE = """unknown AS (
  SELECT req_id, product_name FROM requests_fx WHERE product_name IS NULL
     OR product_name NOT IN (SELECT names FROM catalog_fx WHERE names IS NOT NULL))"""
SQL["unknown_product"] = with_fx(["catalog_fx", "requests_fx"], [UNKNOWN_CTE]) + "SELECT * FROM unknown"
SQL["recommend_sql"] = with_fx(["catalog_fx", "requests_fx", "traits_fx", "recs_fx"], SERVE_CTES + [
    UNKNOWN_CTE.replace("unknown AS", "unk AS"), """known_pick AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY req_id ORDER BY
             md5(concat_ws('|', '123', CAST(req_id AS VARCHAR), CAST(coalesce(pro_ids, -1) AS VARCHAR), half)), half,
             pro_ids NULLS FIRST) AS INTEGER) AS pick
    FROM hybrid WHERE req_id IN (SELECT req_id FROM qprod)) WHERE pick <= 10)"""]) + """SELECT req_id, pick, pro_ids, names AS label, names AS value FROM known_pick
UNION ALL SELECT req_id, 1, CAST(NULL AS INTEGER), '', '' FROM unk"""

# ----------------------------------------------------------------------------- §2.2 pages
import re as _re  # noqa: E402

from sheen.functions.constants import PRODUCT_LINK_MARKER, SKIPPED_REVIEW_URL  # noqa: E402
from sheen.operators.pages import HREF_RE, TITLE_RE  # noqa: E402

_HOST = "https://reviews.example.com"
_SEARCH = "/product/searching.asp/CategoryId="
_SEARCH_TAIL = "/NumberOfReviews=5/SD=DESC/SC=HOWMANY/page="
CATS_CTE = """cats AS (
  SELECT CAST(701 + pro_ids % 9 AS VARCHAR) AS cat_id,
         CAST(ceil(count(*) / CAST(10 AS DOUBLE)) AS INTEGER) AS n_pages
  FROM catalog_fx GROUP BY 1)"""
SQL["frontier_urls"] = with_fx(["catalog_fx"], [CATS_CTE]) + f"""SELECT cat_id, CAST(page AS INTEGER) AS page,
       '{_HOST}{_SEARCH}' || cat_id || '{_SEARCH_TAIL}' || CAST(page AS VARCHAR) AS url
FROM (SELECT cat_id, unnest(range(1, n_pages + 1)) AS page FROM cats)"""
SQL["cap_pages"] = with_fx(["catalog_fx"], [CATS_CTE]) + f"""SELECT cat_id,
  CASE WHEN starts_with(last, prefix) AND contains(tail, '/') AND TRY_CAST(split_part(tail, '/', 1) AS INTEGER) IS NOT NULL
       THEN least(TRY_CAST(split_part(tail, '/', 1) AS INTEGER), 66) ELSE 1 END AS n_search_pages
FROM (SELECT cat_id, prefix, links[-2] AS last, substr(links[-2], length(prefix) + 1) AS tail FROM (
  SELECT cat_id, prefix, [prefix || '1/', prefix || '2/', prefix || CAST(n_pages AS VARCHAR) || '/', prefix || '2/'] AS links
  FROM (SELECT cat_id, n_pages, '{_HOST}{_SEARCH}' || cat_id || '{_SEARCH_TAIL}' AS prefix FROM cats)))"""
_LINKS = f"list_filter(regexp_extract_all(html, {lit(HREF_RE)}, 1), lambda h: contains(h, '/'))"
SQL["page_links"] = (f"SELECT page_id, array_to_string({_LINKS}, '|') AS links, "
                     f"CAST(len({_LINKS}) AS INTEGER) AS n_links FROM pages")
SQL["every_second"] = (f"SELECT page_id, array_to_string(list_filter({_LINKS}, lambda x, i: i % 2 = 1), '|') AS even, "
                       f"array_to_string(list_filter({_LINKS}, lambda x, i: i % 2 = 0), '|') AS odd FROM pages")
SQL["flatten_lists"] = f"SELECT page_id, unnest({_LINKS}) AS link FROM pages"
SQL["title_guard"] = f"SELECT page_id, url FROM pages WHERE regexp_matches(html, {lit(TITLE_RE)})"

_M = _re.escape(PRODUCT_LINK_MARKER)
LINKS_CTE = f"""lk AS (
  SELECT pro_ids, '{PRODUCT_LINK_MARKER}' || CAST(pro_ids AS VARCHAR) || '/page=1/' AS link,
         format('{{:,}}', count(*)) AS n_reviews
  FROM ratings_fx GROUP BY pro_ids),
lkp AS (
  SELECT pro_ids, link, n_reviews, regexp_extract(link, {lit('^(.*?' + _M + '[^/]*)')}, 1) || '/page=' AS canonical,
         CAST(ceil(CAST(regexp_replace(n_reviews, '\\D', '', 'g') AS BIGINT) / CAST(10 AS DOUBLE)) AS INTEGER) AS n_pages
  FROM lk),
expanded AS (
  SELECT pro_ids, CAST(page AS INTEGER) AS page, canonical || CAST(page AS VARCHAR) AS url
  FROM (SELECT pro_ids, canonical, unnest(range(1, greatest(n_pages, 1) + 1)) AS page FROM lkp WHERE n_pages >= 1))"""


def links_sql(body: str) -> str:
    return with_fx(["ratings_fx"], [LINKS_CTE]) + body


SQL["canonical_link"] = links_sql("SELECT pro_ids, canonical FROM lkp")
SQL["extract_id"] = links_sql(f"SELECT pro_ids, regexp_extract(link, {lit(_M + '([^/]*)/')}, 1) AS item_id FROM lk")
SQL["review_page_count"] = links_sql("SELECT pro_ids, n_reviews, n_pages FROM lkp")
SQL["expand_review_pages"] = links_sql("SELECT * FROM expanded")
SQL["skip_bad_pages"] = links_sql(
    f"SELECT * FROM expanded WHERE url <> '{SKIPPED_REVIEW_URL}' AND url NOT IN "
    "(SELECT arg_max(url, page) FROM expanded WHERE pro_ids % 10 = 0 GROUP BY pro_ids)")
SQL["page_text_fields"] = raw_sql(
    "SELECT DISTINCT pro_ids, names, ratings, repurchases, pkg_quals, prices, ingredients, brands, brand_ids "
    "FROM reviews_raw_fx")
SQL["page_review_arrays"] = raw_sql(
    "SELECT pro_ids, count(*) AS n_users, count(*) AS n_chars, count(*) AS n_reviews, count(*) AS n_lipies, "
    "count(*) AS n_dates FROM reviews_raw_fx GROUP BY pro_ids")
SQL["explode_reviews"] = raw_sql(
    "SELECT pro_ids, names, ratings, repurchases, pkg_quals, prices, nullif(ingredients, '') AS ingredients, "
    "brands, brand_ids, users, chars, reviews, lipies, dates, cat_id FROM reviews_raw_fx")
SQL["quarantine_pages"] = raw_sql(
    "SELECT 'good' AS status, count(*) AS n_reviews, CAST(0 AS BIGINT) AS n_rejected FROM reviews_raw_fx "
    "UNION ALL SELECT 'rejected', CAST(0 AS BIGINT), count(*) FROM pages")
SQL["tag_category"] = raw_sql("SELECT pro_ids, users, lipies, cat_id FROM reviews_raw_fx")

# ----------------------------------------------------------------------------- §2.1
SQL["sink_ratings_csv"] = with_fx(["ratings_fx"]) + "SELECT pro_ids, uid, lipies FROM ratings_fx"
SQL["scan_ratings_csv"] = SQL["sink_ratings_csv"]
SQL["sink_by_category"] = clean_sql(
    "SELECT pro_ids, users, lipies, cat_id FROM clean_fx WHERE cat_id <> '705' OR lipies >= 3")
SQL["scan_ratings_rejects"] = with_fx(["ratings_fx"]) + """SELECT
  CASE uid % 10 WHEN 3 THEN 'types' WHEN 4 THEN 'columns' WHEN 5 THEN 'missing' ELSE 'good' END AS reason,
  CAST(pro_ids AS VARCHAR) || ',' || CASE uid % 10 WHEN 3 THEN 'user ' || uid || ',' || CAST(lipies AS INTEGER) WHEN 4 THEN CAST(uid AS VARCHAR)
    WHEN 5 THEN uid || ',' ELSE uid || ',' || CAST(lipies AS INTEGER) END AS line
FROM ratings_fx"""
SQL["load_categories"] = clean_sql("SELECT cat_id, count(*) AS n FROM clean_fx GROUP BY cat_id")
SQL["save_clean"] = clean_sql("SELECT pro_ids, users, lipies, dates, " + ", ".join(TRAITS) + " FROM clean_fx")
SQL["ratings_marts"] = clean_sql("SELECT pro_ids, lipies, uid FROM clean_fx JOIN uid_fx USING (users)",
                                 [UID_CTE])
SQL["load_artifacts"] = SQL["recommend_sql"]
_USERS, _RATED = "(SELECT count(DISTINCT uid) FROM ratings_fx)", "(SELECT count(DISTINCT pro_ids) FROM ratings_fx)"
SQL["save_artifacts"] = feat_sql("SELECT unnest(['catalog', 'traits', 'features', 'labels', 'exemplar_members', 'recs', "
    "'user_factors', 'als_users', 'product_factors', 'als_products']) AS artifact, unnest(["
    "(SELECT count(*) FROM catalog_fx), (SELECT count(*) FROM traits_fx), (SELECT count(*) FROM feat), "
    "(SELECT count(*) FROM vocab), (SELECT count(*) FROM vocab), "
    f"{_USERS}, {_USERS}, {_USERS}, {_RATED}, {_RATED}]) AS n_rows", fx=["ratings_fx", "traits_fx"])
