"""SQL counterparts of the registered queries, put together from common table expressions.

Written from the meaning of each operator in plain SQL over the given tables, not from the Spark
plans: joins where Spark derives keys, aggregates over joined rows where Spark aggregates first.
"""

from __future__ import annotations

from larder.catalogue.fixtures import (
    CATALOGUE_COLUMNS,
    CATEGORY_LISTS,
    CHANGED,
    DUMP_LINE,
    GAPS,
    GONE,
    OFFER_COLUMNS,
    SHOP_COLUMNS,
    TIE_BREAKERS,
    TWICE,
    VERSION_COLUMNS,
)
from larder.catalogue.queries import CUT
from larder.functions.nutrients import CORE_NUTRIENTS, NUTRIENT_BOUNDS
from larder.functions.text import NOISE_VALUES
from larder.plans.reports import GOOD_GRADES, GRADES, NOISE_BRANDS, NOISE_CATEGORIES
from larder.schemas import BRONZE_COLUMNS, FOREIGN_KEYS, MAX_LENGTHS, NUTRIENT_COLUMNS, REQUIRED, TEXT_COLUMNS, UNIQUE_KEYS


def _q(name: str) -> str:
    return f'"{name}"'


def _plain(name: str) -> str:
    return name.replace("-", "_")


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _columns(columns: dict[str, str], **parts: str) -> str:
    return ", ".join(f"{sql.format(**parts) if parts else sql} AS {_q(name)}" for name, sql in columns.items())


KEYS = ", ".join(TIE_BREAKERS)
NEWEST = "last_modified_ts DESC NULLS LAST, " + ", ".join(f"{k} DESC" for k in TIE_BREAKERS)


# --- scalar pieces ------------------------------------------------------------------------------


def normalise(x: str) -> str:
    return rf"lower(trim(regexp_replace({x}, '[\s\x0B]+', ' ', 'g')))"


def canonical(x: str) -> str:
    return rf"trim(regexp_replace(strip_accents(lower(trim({x}))), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def noise_to_null(x: str) -> str:
    t = f"lower(trim({x}))"
    return (
        f"CASE WHEN {t} IN {_in(NOISE_VALUES)} OR regexp_matches({t}, '^[0-9]+$') OR length({t}) <= 1 "
        f"THEN NULL ELSE {t} END"
    )


def number(x: str) -> str:
    return f"try_cast(replace({x}, ',', '.') AS double)"


def items(x: str) -> str:
    return f"list_transform(string_split(replace({x}, ';', ','), ','), lambda t: {normalise('t')})"


def meaningful(xs: str) -> str:
    return (
        f"list_filter({xs}, lambda t: length(t) > 1 AND NOT regexp_matches(t, '^[0-9]+$') "
        f"AND t NOT IN {_in(NOISE_VALUES)})"
    )


def codes(xs: str) -> str:
    return meaningful(
        f"list_transform({xs}, lambda t: CASE WHEN contains(t, ':') THEN split_part(t, ':', 2) ELSE t END)"
    )


def clamped(x: str, name: str) -> str:
    low, high = NUTRIENT_BOUNDS[name]
    return f"CASE WHEN {x} BETWEEN {low} AND {high} THEN {x} END"


PREFERRED = "coalesce(nullif(product_name_fr, ''), nullif(product_name, ''), product_name_en)"

# --- product versions and the silver table ------------------------------------------------------

VERSIONS = f"""
versions AS (
  SELECT {_columns(VERSION_COLUMNS, epoch="epoch(l_shipdate)")}, {KEYS}, CAST(l_shipdate AS date) AS ship_date
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
stamped AS (
  SELECT *, coalesce(CAST(last_modified_ts AS date), DATE '2000-01-01') AS event_date
  FROM (SELECT *, make_timestamp(CAST(last_modified_t AS bigint) * 1000000) AS last_modified_ts FROM versions)
)"""

TAGGED_COLUMNS = f"""
  {items("brands")} AS brands_arr,
  {meaningful(items("brands"))} AS brands_clean_arr,
  {meaningful(items("coalesce(categories_tags, categories)"))} AS categories_arr,
  {codes(meaningful(items("coalesce(categories_tags, categories)")))} AS categories_codes,
  {meaningful(items("coalesce(countries_tags, countries)"))} AS countries_arr,
  {codes(meaningful(items("coalesce(countries_tags, countries)")))} AS countries_codes"""

PRIMARY_COLUMNS = """
  brands_clean_arr[1] AS brand_primary,
  categories_codes[1] AS primary_category_code,
  countries_codes[1] AS country_primary_code"""

MEASURES = [c for c in VERSION_COLUMNS if c in NUTRIENT_COLUMNS]


def newest(source: str, keys: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {NEWEST}) = 1"


def silver(name: str, keys: str) -> str:
    """Expressions for a silver table called ``name`` with one row per ``keys``."""
    flag = "CASE WHEN length({0}) > 0 THEN 1 ELSE 0 END"
    parsed = ", ".join(f"{number(_q(c))} AS {_q(c)}" for c in MEASURES)
    kept = ", ".join(f"{clamped(_q(c), c)} AS {_q(c)}" for c in MEASURES)
    core = " + ".join(f"CASE WHEN {_q(c)} IS NULL THEN 0 ELSE 1 END" for c in CORE_NUTRIENTS)
    return f"""
{name}_newest AS ({newest("stamped", keys)}),
{name}_tagged AS (
  SELECT * REPLACE ({normalise("brands")} AS brands, {normalise("categories")} AS categories,
    {normalise("countries")} AS countries, {normalise("nutriscore_grade")} AS nutriscore_grade, {parsed}),
    CAST(NULL AS varchar) AS ecoscore_grade, CAST(NULL AS varchar) AS lang,
    CAST(NULL AS double) AS "saturated-fat_100g", CAST(NULL AS double) AS fiber_100g,
    {number("salt_100g")} / 2.5 AS sodium_100g,
    {PREFERRED} AS product_name_pref, {TAGGED_COLUMNS}
  FROM {name}_newest
),
{name}_clamped AS (
  SELECT * REPLACE ({kept}), salt_100g AS salt_parsed, sugars_100g AS sugars_parsed, {PRIMARY_COLUMNS}
  FROM {name}_tagged
),
{name}_scored AS (
  SELECT *, {flag.format("product_name_pref")} AS has_name, {flag.format("brand_primary")} AS has_brands,
    {core} AS core_nutrients_count
  FROM {name}_clamped
),
{name} AS (
  SELECT *, CAST(has_name + has_brands + core_nutrients_count AS double) / 7.0 AS completeness_score,
    CAST(to_json(list_filter([
      CASE WHEN salt_parsed > 25 THEN 'salt_gt_25' END,
      CASE WHEN sugars_parsed > 80 THEN 'sugars_gt_80' END,
      CASE WHEN has_brands = 0 THEN 'brand_missing' END,
      CASE WHEN coalesce(primary_category_code, '') = '' THEN 'cat_missing' END
    ], lambda t: t IS NOT NULL)) AS varchar) AS quality_issues_json
  FROM {name}_scored
)"""


PRODUCTS = silver("products", "code")
SNAPSHOTS = silver("snapshots", "code, event_date")

# --- star, on natural keys ----------------------------------------------------------------------

STAR = f"""
keyed AS (
  SELECT *, {canonical(noise_to_null("brand_primary"))} AS brand_name,
    {canonical("primary_category_code")} AS category_code,
    {canonical("country_primary_code")} AS country_code,
    CAST(to_json(countries_codes) AS varchar) AS countries_multi
  FROM products
),
dim_time AS (
  SELECT DISTINCT CAST(strftime(event_date, '%Y%m%d') AS integer) AS time_sk, event_date AS date,
    CAST(year(event_date) AS integer) AS year, CAST(month(event_date) AS integer) AS month,
    CAST(day(event_date) AS integer) AS day, CAST(weekofyear(event_date) AS integer) AS week,
    CAST(weekofyear(event_date) AS integer) AS iso_week, CAST(isoyear(event_date) AS integer) AS iso_year
  FROM snapshots
),
dim_brand AS (SELECT DISTINCT brand_name FROM keyed WHERE brand_name <> ''),
dim_category AS (SELECT DISTINCT category_code FROM keyed WHERE category_code <> ''),
dim_country AS (SELECT DISTINCT country_code FROM keyed WHERE country_code <> ''),
dim_product AS (
  SELECT code, product_name_pref AS product_name, b.brand_name, c.category_code, countries_multi,
    CAST(event_date AS timestamp) AS effective_from, 1 AS is_current
  FROM keyed k LEFT JOIN dim_brand b ON b.brand_name = k.brand_name
  LEFT JOIN dim_category c ON c.category_code = k.category_code
  WHERE code <> ''
),
exploded AS (
  SELECT DISTINCT code, {canonical("tag")} AS category_code
  FROM (SELECT code, unnest(categories_codes) AS tag FROM products) WHERE tag <> ''
),
bridge_all AS (SELECT * FROM exploded WHERE category_code <> ''),
bridge AS (SELECT e.* FROM bridge_all e JOIN dim_category USING (category_code) JOIN dim_product USING (code)),
fact AS (
  SELECT s.code, t.time_sk, {", ".join(f"s.{_q(c)} AS {_q(_plain(c))}" for c in NUTRIENT_COLUMNS)},
    s.nutriscore_grade, s.nova_group, s.ecoscore_grade, s.completeness_score, s.quality_issues_json
  FROM snapshots s JOIN dim_product p ON p.code = s.code JOIN dim_time t ON t.date = s.event_date
)"""


def with_versions(select: str) -> str:
    return f"WITH {VERSIONS}\n{select}"


def with_products(select: str) -> str:
    return f"WITH {VERSIONS}, {PRODUCTS}\n{select}"


def with_snapshots(select: str) -> str:
    return f"WITH {VERSIONS}, {SNAPSHOTS}\n{select}"


def with_star(select: str) -> str:
    return f"WITH {VERSIONS}, {PRODUCTS}, {SNAPSHOTS}, {STAR}\n{select}"


def _mean(column: str, digits: int) -> str:
    return f"round(CAST(sum(CAST({column} AS decimal(18, 10))) AS double) / count(*), {digits})"


ORACLE_SQL: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


# --- columns and text ---------------------------------------------------------------------------

oracle(
    "column_conform",
    with_versions(
        "SELECT "
        + ", ".join(
            (_q(c) if c in VERSION_COLUMNS else "CAST(NULL AS varchar)") + f" AS {_q(_plain(c))}"
            for c in BRONZE_COLUMNS
        )
        + " FROM versions"
    ),
)
oracle("text_normalise", f"SELECT doc_id, {normalise('text')} AS normalised FROM documents")
oracle(
    "text_normalise_brands",
    with_versions(f"SELECT code, {KEYS}, {normalise('brands')} AS brands FROM versions"),
)
oracle("canon_text", f"SELECT doc_id, {canonical('text')} AS canonical FROM documents")
oracle(
    "noise_to_null",
    with_versions(
        f"SELECT brands, {noise_to_null('brands')} AS kept, count(*) AS n FROM versions GROUP BY 1, 2"
    ),
)
oracle(
    "preferred_name", with_versions(f"SELECT code, {KEYS}, {PREFERRED} AS product_name_pref FROM versions")
)

# --- tag lists ----------------------------------------------------------------------------------

_TAGGED = f"(SELECT code, {KEYS}, {TAGGED_COLUMNS} FROM stamped)"


def _lists(*names: str) -> str:
    joined = ", ".join(f"array_to_string({n}, '|') AS {n}" for n in names)
    return with_versions(f"SELECT code, {KEYS}, {joined} FROM {_TAGGED}")


oracle("clean_tags_brands", _lists("brands_arr", "brands_clean_arr"))
oracle("tag_codes_categories", _lists("categories_arr", "categories_codes"))
oracle("tag_codes_countries", _lists("countries_arr", "countries_codes"))
oracle("primary_elements", with_versions(f"SELECT code, {KEYS}, {PRIMARY_COLUMNS} FROM {_TAGGED}"))

# --- nutrients ----------------------------------------------------------------------------------

oracle(
    "clamp_nutrients",
    with_versions(
        f"SELECT code, {KEYS}, "
        + ", ".join(f"{clamped(number(_q(c)), c)} AS {_q(_plain(c))}" for c in NUTRIENT_BOUNDS)
        + " FROM versions"
    ),
)
oracle(
    "salt_sodium_column",
    with_versions(
        f"SELECT code, {KEYS}, {clamped('salt', 'salt_100g')} AS salt_100g, salt / 2.5 AS sodium_100g "
        f"FROM (SELECT *, {number('salt_100g')} AS salt FROM versions)"
    ),
)
oracle(
    "salt_sodium_row",
    with_versions(
        f"""SELECT code, {KEYS}, {clamped("coalesce(salt, sodium * 2.5)", "salt_100g")} AS salt_100g,
  coalesce(sodium, salt / 2.5) AS sodium_100g
FROM (SELECT *, {number("salt_100g")} AS salt,
  CASE WHEN nova_group = '3' THEN NULL ELSE {number("proteins_100g")} END AS sodium FROM versions)"""
    ),
)

# --- duplicates ---------------------------------------------------------------------------------

_NEWEST_PRODUCT = f"({newest('stamped', 'code')})"
oracle(
    "keep_latest_products",
    with_versions(
        f"SELECT code, {KEYS}, CAST(last_modified_ts AS varchar) AS last_modified_ts, "
        f"CAST(event_date AS varchar) AS event_date, countries FROM {_NEWEST_PRODUCT}"
    ),
)
oracle(
    "keep_latest_snapshots",
    with_versions(
        f"SELECT code, {KEYS}, CAST(event_date AS varchar) AS event_date "
        f"FROM ({newest('stamped', 'code, event_date')})"
    ),
)
oracle(
    "keep_latest_events",
    "SELECT user_id, event_id, epoch_us(ts) AS ts_micros, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1",
)
oracle("keep_any", with_versions("SELECT DISTINCT code FROM versions"))
oracle("distinct_brands", with_versions("SELECT brands, countries FROM versions GROUP BY ALL"))
oracle(
    "upsert",
    with_versions(
        f"SELECT code, {KEYS}, CAST(event_date AS varchar) AS event_date FROM {_NEWEST_PRODUCT}"
    ),
)

oracle(
    "upsert_stored",
    with_versions(
        f"SELECT code, {KEYS}, CAST(event_date AS varchar) AS event_date FROM {_NEWEST_PRODUCT}"
    ),
)

# --- whole silver table -------------------------------------------------------------------------

oracle(
    "event_date_default",
    with_versions(
        f"SELECT code, {KEYS}, CAST(last_modified_ts AS varchar) AS last_modified_ts, "
        "CAST(event_date AS varchar) AS event_date FROM stamped"
    ),
)
oracle(
    "completeness",
    with_snapshots(
        "SELECT code, CAST(event_date AS varchar) AS event_date, has_name, has_brands, "
        "core_nutrients_count, completeness_score FROM snapshots"
    ),
)
oracle(
    "quality_issues",
    with_snapshots("SELECT code, CAST(event_date AS varchar) AS event_date, quality_issues_json FROM snapshots"),
)
oracle(
    "run_metrics",
    with_products(
        """SELECT count(*) AS rows_total, count(code) AS rows_with_code,
  count(sugars_100g) AS rows_with_sugars_100g, round(avg(completeness_score), 9) AS avg_completeness_score,
  count(*) > 0 AS has_rows, count(code) / count(*) >= 0.99 AS codes_complete,
  avg(completeness_score) IS NOT NULL AS has_score FROM products"""
    ),
)

_LISTS = (
    "brands_arr",
    "brands_clean_arr",
    "categories_arr",
    "categories_codes",
    "countries_arr",
    "countries_codes",
)
_DERIVED = (
    "product_name_pref",
    "brand_primary",
    "primary_category_code",
    "country_primary_code",
    "has_name",
    "has_brands",
    "core_nutrients_count",
    "completeness_score",
    "quality_issues_json",
)


def _silver_view(table: str, list_form: str) -> str:
    columns = [f"{_q(c)} AS {_q(_plain(c))}" for c in (*TEXT_COLUMNS, *NUTRIENT_COLUMNS, *_DERIVED)]
    columns += [f"CAST({c} AS varchar) AS {c}" for c in ("last_modified_ts", "event_date")]
    columns += [f"{list_form.format(c)} AS {c}" for c in _LISTS]
    return f"SELECT {', '.join(columns)} FROM {table}"


oracle("silver_products", with_products(_silver_view("products", "array_to_string({0}, '|')")))
oracle("silver_snapshots", with_snapshots(_silver_view("snapshots", "array_to_string({0}, '|')")))
# A text file does not tell an empty field from a missing one: both come back as NULL.
oracle(
    "bronze_round_trip",
    with_versions(
        "SELECT " + ", ".join(f"nullif({_q(c)}, '') AS {_q(_plain(c))}" for c in VERSION_COLUMNS) + " FROM versions"
    ),
)
oracle(
    "sample_csv_view",
    with_products(_silver_view("products", "CAST(to_json({0}) AS varchar)") + " ORDER BY code LIMIT 200"),
)

# --- star ---------------------------------------------------------------------------------------

oracle("dim_time", with_star("SELECT * REPLACE (CAST(date AS varchar) AS date) FROM dim_time"))
oracle("dim_brand", with_star("SELECT brand_name FROM dim_brand"))
oracle(
    "dim_category",
    with_star(
        "SELECT category_code, CAST(NULL AS varchar) AS category_name_fr, CAST(NULL AS integer) AS level FROM dim_category"
    ),
)
oracle("dim_category_all", with_star("SELECT DISTINCT category_code FROM bridge_all"))
oracle("dim_country", with_star("SELECT country_code, CAST(NULL AS varchar) AS country_name_fr FROM dim_country"))
_PRODUCT = with_star(
    "SELECT * REPLACE (CAST(effective_from AS varchar) AS effective_from), '9999-12-31' AS effective_to FROM dim_product"
)
oracle("dim_product", _PRODUCT)
oracle("dim_product_lookup", _PRODUCT)
oracle("bridge_primary", with_star("SELECT code, category_code FROM bridge"))
oracle("bridge_all", with_star("SELECT code, category_code FROM bridge_all"))
oracle("fact_snapshot", with_star("SELECT * FROM fact"))
oracle("fact_snapshot_lookup", with_star("SELECT * FROM fact"))
oracle(
    "unresolved_facts",
    with_snapshots(
        "SELECT count(*) FILTER (coalesce(code, '') = '') AS without_product, "
        "count(*) FILTER (event_date IS NULL) AS without_date FROM snapshots"
    ),
)

# --- incremental load ---------------------------------------------------------------------------

_EARLY = silver("early", "code, event_date").replace(
    "FROM stamped QUALIFY", f"FROM stamped WHERE ship_date < DATE '{CUT}' QUALIFY"
)
_LOADED = f"""WITH {VERSIONS}, {SNAPSHOTS}, {_EARLY},
loaded AS (
  SELECT * FROM early
  UNION ALL BY NAME
  SELECT * FROM snapshots s
  WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.code = s.code AND e.event_date = s.event_date)
)
SELECT code, CAST(strftime(event_date, '%Y%m%d') AS integer) AS time_sk, sugars_100g, completeness_score FROM loaded"""
oracle("append_no_dupe_rows", _LOADED)
oracle("append_idempotent", _LOADED)

# --- reports ------------------------------------------------------------------------------------

oracle(
    "report_brand_grade_share",
    with_star(
        f"""SELECT brand_name, CAST(n_ab AS bigint) AS n_ab, n_total, round(n_ab / n_total * 100, 2) AS pct_ab
FROM (
  SELECT brand_name, count(*) FILTER (nutriscore_grade IN {_in(GOOD_GRADES)}) AS n_ab, count(*) AS n_total
  FROM fact JOIN dim_product USING (code) JOIN dim_brand USING (brand_name)
  WHERE brand_name NOT IN {_in(NOISE_BRANDS)} AND nutriscore_grade IN {_in(GRADES)}
  GROUP BY brand_name
) WHERE n_total >= 20
ORDER BY pct_ab DESC, n_total DESC, brand_name LIMIT 10"""
    ),
)
oracle(
    "report_grade_by_category",
    with_star(
        f"""SELECT category_code AS category, nutriscore_grade, count(*) AS n
FROM fact JOIN dim_product USING (code)
WHERE nutriscore_grade IN {_in(GRADES)} AND category_code NOT IN {_in(NOISE_CATEGORIES)}
GROUP BY 1, 2"""
    ),
)
oracle(
    "report_sugar_heatmap",
    with_star(
        f"""SELECT coalesce(category_code, 'inconnu') AS category, country_code,
  {_mean("sugars_100g", 2)} AS avg_sugars_100g, count(*) AS n
FROM (
  SELECT *, unnest(json_extract_string(countries_multi, '$[*]')) AS country_code
  FROM fact JOIN dim_product USING (code)
  WHERE json_type(try_cast(countries_multi AS JSON)) = 'ARRAY'
)
WHERE sugars_100g IS NOT NULL AND country_code <> ''
  AND coalesce(category_code, '') NOT IN {_in(NOISE_CATEGORIES)}
GROUP BY 1, 2 HAVING count(*) >= 10"""
    ),
)
oracle(
    "report_brand_completeness",
    with_star(
        f"""SELECT brand_name, {_mean("completeness_score", 3)} AS avg_completeness, count(*) AS n
FROM fact JOIN dim_product USING (code)
WHERE brand_name NOT IN {_in(NOISE_BRANDS)} AND completeness_score IS NOT NULL
GROUP BY 1 HAVING count(*) >= 20"""
    ),
)
oracle(
    "report_anomalies",
    with_star(
        """SELECT code, coalesce(product_name, 'inconnu') AS product_name,
  coalesce(category_code, 'inconnu') AS category, salt_100g, sugars_100g
FROM fact JOIN dim_product USING (code) WHERE salt_100g > 25 OR sugars_100g > 80"""
    ),
)


def _weekly(year: str) -> str:
    return with_star(
        f"""SELECT {year}, iso_week, {_mean("completeness_score", 3)} AS avg_completeness, count(*) AS n
FROM fact JOIN dim_time USING (time_sk) WHERE completeness_score IS NOT NULL
GROUP BY 1, 2 HAVING count(*) >= 20"""
    )


oracle("report_weekly_completeness", _weekly("year"))
oracle(
    "report_weekly_completeness_span",
    _weekly("year").replace("WHERE completeness", "WHERE date BETWEEN DATE '1995-11-06' AND DATE '1996-02-25' AND completeness"),
)
oracle("report_weekly_completeness_iso_year", _weekly("iso_year"))
oracle(
    "report_least_complete_categories",
    with_star(
        f"""SELECT coalesce(category_code, 'inconnu') AS category,
  {_mean("completeness_score", 3)} AS avg_completeness, count(*) AS n
FROM fact JOIN dim_product USING (code) WHERE completeness_score IS NOT NULL
GROUP BY 1 HAVING count(*) >= 1000
ORDER BY avg_completeness, n DESC, category LIMIT 20"""
    ),
)

# --- audits -------------------------------------------------------------------------------------


def _union(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


oracle(
    "audit_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
oracle(
    "audit_foreign_keys",
    "SELECT doc_id, count(*) AS n FROM documents d "
    "WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1",
)
oracle(
    "audit_nulls",
    with_versions(
        _union(
            [
                f"SELECT '{c}' AS column_name, count(*) FILTER ({_q(c)} IS NULL) AS n_null FROM versions"
                for c in VERSION_COLUMNS
            ]
        )
    ),
)
oracle(
    "audit_bounds",
    with_versions(
        _union(
            [
                f"SELECT '{c}' AS column_name, count(*) FILTER (NOT ({number(_q(c))} BETWEEN {low} AND {high})) "
                "AS n_outside FROM versions"
                for c, (low, high) in NUTRIENT_BOUNDS.items()
            ]
        )
    ),
)
oracle(
    "audit_lengths",
    _union(
        [
            f"SELECT '{c}' AS column_name, count(*) FILTER (length({c}) > {n}) AS n_too_long FROM documents"
            for c, n in (("text", 4096), ("lang", 64), ("source", 4))
        ]
    ),
)
oracle(
    "audit_interval",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS varchar) AS o_orderdate, "
    "CAST(l_shipdate AS varchar) AS l_shipdate "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT (l_shipdate > o_orderdate)",
)

# Gold table -> (its counterpart here, natural key)
_TABLES = {
    "dim_time": ("dim_time", "time_sk"),
    "dim_brand": ("dim_brand", "brand_name"),
    "dim_category": ("dim_category", "category_code"),
    "dim_country": ("dim_country", "country_code"),
    "dim_product": ("dim_product", "code"),
    "bridge_product_category": ("bridge", "code, category_code"),
    "fact_nutrition_snapshot": ("fact", "code, time_sk"),
}
oracle(
    "audit_counts",
    with_star(
        _union([f"SELECT '{name}' AS table_name, count(*) AS n FROM {here}" for name, (here, _) in _TABLES.items()])
    ),
)


def _check(check: str, table: str, columns: str, violations: str, source: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{columns}' AS \"columns\", "
        f"CAST({violations} AS bigint) AS violations FROM {source}"
    )


# Surrogate keys are checked by what they stand for.
_STANDS_FOR = {
    "brand_sk": "brand_name",
    "category_sk": "category_code",
    "primary_category_sk": "category_code",
    "country_sk": "country_code",
    "product_sk": "code",
    "parent_category_sk": "NULL",
    "category_name_fr": "CAST(NULL AS varchar)",
    "country_name_fr": "CAST(NULL AS varchar)",
    "effective_to": "TIMESTAMP '9999-12-31'",
}


def _star_checks(tables: dict[str, str], stands_for: dict[str, str]) -> str:
    """All checks of the star over these relations; ``stands_for`` gives the column for a key where its name differs."""

    def here(column: str) -> str:
        return stands_for.get(column, column)

    checks = []
    for table, keys in UNIQUE_KEYS.items():
        for key in keys:
            grouped = f"(SELECT count(*) AS n FROM {tables[table]} GROUP BY {', '.join(map(here, key))})"
            checks.append(_check("unique", table, ",".join(key), "coalesce(sum(n - 1), 0)", grouped))
    for child, column, parent, key in FOREIGN_KEYS:
        orphans = (
            f"(SELECT {here(column)} AS k FROM {tables[child]}) c WHERE k IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {tables[parent]} p WHERE p.{here(key)} = c.k)"
        )
        checks.append(_check("foreign key", child, column, "count(*)", orphans))
    for table, columns in REQUIRED.items():
        checks += [_check("not null", table, c, f"count(*) FILTER ({here(c)} IS NULL)", tables[table]) for c in columns]
    for table, limits in MAX_LENGTHS.items():
        for c, limit in limits.items():
            checks.append(_check("length", table, c, f"count(*) FILTER (length({here(c)}) > {limit})", tables[table]))
    ends_early = f"count(*) FILTER (NOT ({here('effective_to')} > effective_from))"
    checks.append(_check("interval", "dim_product", "effective_from,effective_to", ends_early, tables["dim_product"]))
    return _union(checks)


oracle("audit_star", with_star(_star_checks({name: here for name, (here, _) in _TABLES.items()}, _STANDS_FOR)))

# What a surrogate key stands for stays in a column of its own where the natural key is broken.
_KEPT = {
    "dim_brand": "*, brand_name AS brand_sk",
    "dim_category": (
        "*, category_code AS category_sk, CAST(NULL AS varchar) AS category_name_fr, "
        "CASE length(category_code) % 3 WHEN 0 THEN category_code WHEN 1 THEN 'nowhere' END AS parent_category_sk"
    ),
    "dim_country": "*, country_code AS country_sk, CAST(NULL AS varchar) AS country_name_fr",
    "dim_product": "*, code AS product_sk, category_code AS primary_category_sk, brand_name AS brand_sk, TIMESTAMP '9999-12-31' AS effective_to",
    "bridge_product_category": "*, code AS product_sk, category_code AS category_sk",
    "fact_nutrition_snapshot": "*, code AS product_sk",
}


def _broken(table: str) -> str:
    kept = f"SELECT {_KEPT.get(table, '*')} FROM {_TABLES[table][0]} WHERE NOT ({GONE.get(table, 'false')})"
    condition, changes = TWICE.get(table, ("false", {}))
    copies = ", ".join(f"{sql} AS {c}" for c, sql in changes.items())
    condition = condition.format(number="CAST(code AS bigint)")
    rows = f"SELECT * FROM kept UNION ALL SELECT *{f' REPLACE ({copies})' if copies else ''} FROM kept WHERE {condition}"
    changed = ", ".join(f"{sql.format(end=c)} AS {c}" for c, sql in CHANGED[table].items())
    return (
        f"broken_{table} AS (WITH kept AS ({kept}), both_ AS ({rows}) "
        f"SELECT *{f' REPLACE ({changed})' if changed else ''} FROM both_)"
    )


oracle(
    "audit_star_broken",
    f"WITH {VERSIONS}, {PRODUCTS}, {SNAPSHOTS}, {STAR},\n"
    + ",\n".join(_broken(name) for name in _TABLES)
    + "\n"
    + _star_checks({name: f"broken_{name}" for name in _TABLES}, {}),
)
oracle(
    "load_gaps",
    with_snapshots(
        f"""SELECT count(*) - count(*) FILTER (gap) AS inserted, count(*) FILTER (gap) AS rejected,
  count(*) FILTER (coalesce(code, '') = '') AS without_product, count(*) FILTER (event_date IS NULL) AS without_date
FROM (SELECT *, coalesce(code, '') = '' OR event_date IS NULL AS gap
  FROM (SELECT * REPLACE ({GAPS["code"]} AS code, {GAPS["event_date"].format(code="CAST(code AS bigint)")} AS event_date) FROM snapshots))"""
    ),
)


def _profile(layer: str, table: str, value: str) -> str:
    outside = ", ".join(
        f"count(*) FILTER (NOT ({value.format(_q(c))} BETWEEN {low} AND {high})) AS {_q(_plain(c) + '_outside')}"
        for c, (low, high) in NUTRIENT_BOUNDS.items()
    )
    return (
        f"SELECT '{layer}' AS layer, count(*) AS n_rows, count(*) - count(DISTINCT code) AS n_surplus, {outside} FROM {table}"
    )


oracle(
    "bronze_vs_silver",
    with_products(_union([_profile("bronze", "versions", number("{0}")), _profile("silver", "products", "{0}")])),
)

# --- several sources, linkage, history ----------------------------------------------------------

oracle(
    "union_of_sources",
    """SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance,
  c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS varchar), 'supplier' FROM supplier""",
)
oracle(
    "fuzzy_linkage",
    f"""WITH names AS (SELECT DISTINCT c_nationkey AS block, {canonical("c_name")} AS name FROM customer)
SELECT a.block, a.name AS left_name, b.name AS right_name, CAST(levenshtein(a.name, b.name) AS integer) AS distance
FROM names a JOIN names b ON a.block = b.block AND a.name < b.name
WHERE levenshtein(a.name, b.name) <= 1""",
)

_LINKS = f"""
catalogue AS (SELECT {_columns(CATALOGUE_COLUMNS)} FROM part),
offers AS (SELECT {_columns(OFFER_COLUMNS)} FROM lineitem JOIN part ON l_partkey = p_partkey),
master_names AS (SELECT DISTINCT size_block AS block, {canonical("title")} AS name FROM catalogue),
offer_names AS (SELECT DISTINCT size_block AS block, {canonical("title")} AS name FROM offers),
links AS (
  SELECT o.block, o.name, m.name AS master_name, CAST(levenshtein(m.name, o.name) AS integer) AS distance
  FROM offer_names o LEFT JOIN master_names m ON m.block = o.block AND levenshtein(m.name, o.name) <= 2
  QUALIFY row_number() OVER (PARTITION BY o.block, o.name ORDER BY levenshtein(m.name, o.name), m.name) = 1
)"""
oracle("link_offers", f"WITH {_LINKS}\nSELECT * FROM links")


def _survivor(attribute: str) -> str:
    return (
        f"arg_min({attribute}, struct_pack(p := priority, r := record_id)) "
        f"FILTER ({attribute} IS NOT NULL) AS {attribute}"
    )


oracle(
    "golden_record",
    f"""WITH {_LINKS},
records AS (
  SELECT size_block AS block, {canonical("title")} AS name, 0 AS priority, record_id, brand, category, offer_price
  FROM catalogue
  UNION ALL
  SELECT l.block, coalesce(l.master_name, l.name), 1, record_id, brand, category, offer_price
  FROM offers JOIN links l ON l.block = size_block AND l.name = {canonical("title")}
)
SELECT block, name, count(*) AS n_records, count(DISTINCT priority) AS n_sources,
  {_survivor("brand")}, {_survivor("category")}, {_survivor("offer_price")}
FROM records GROUP BY block, name""",
)



def _grams(name: str, q: int) -> str:
    marked = f"('{'#' * (q - 1)}' || {name} || '{'$' * (q - 1)}')"
    return f"list_distinct(list_transform(range(1, length({name}) + {q}), lambda i: substr({marked}, i::INT, {q})))"


def _gram_pairs(left: str, right: str, q: int, threshold: float, which: str = "true") -> str:
    return f"""SELECT a.block, a.name AS left_name, b.name AS right_name,
  round(len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))), 6) AS similarity
FROM (SELECT *, {_grams("name", q)} AS g FROM {left}) a JOIN (SELECT *, {_grams("name", q)} AS g FROM {right}) b ON a.block = b.block
WHERE {which} AND len(list_intersect(a.g, b.g)) >= {threshold} * (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g)))"""


oracle("similar_titles_grams", f"WITH {_LINKS}\n{_gram_pairs('master_names', 'offer_names', 2, 0.7)}")
oracle(
    "similar_titles_edits",
    f"""WITH {_LINKS}
SELECT a.block, a.name AS left_name, b.name AS right_name, CAST(levenshtein(a.name, b.name) AS integer) AS distance
FROM master_names a JOIN offer_names b ON a.block = b.block WHERE levenshtein(a.name, b.name) <= 4""",
)
oracle(
    "similar_customers_grams",
    f"""WITH names AS (SELECT DISTINCT c_nationkey AS block, {canonical("c_name")} AS name FROM customer)
{_gram_pairs("names", "names", 3, 0.9, "a.name < b.name")}""",
)

# All names against all names of a block, links followed one by one.
oracle(
    "golden_record_clusters",
    f"""WITH RECURSIVE records AS (
  SELECT size_block AS block, {canonical("title")} AS name, 0 AS priority, record_id, brand, category, offer_price
  FROM (SELECT {_columns(CATALOGUE_COLUMNS)} FROM part)
  UNION ALL
  SELECT size_block, {canonical("title")}, 1, record_id, brand, category, offer_price
  FROM (SELECT {_columns(OFFER_COLUMNS)} FROM lineitem JOIN part ON l_partkey = p_partkey)
  UNION ALL
  SELECT size_block, {canonical("title")}, 2, record_id, brand, category, offer_price
  FROM (SELECT {_columns(SHOP_COLUMNS)} FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity < 10)
),
names AS (SELECT block, name, list(DISTINCT priority) AS places FROM records GROUP BY block, name),
links AS (
  SELECT a.block, a.name AS a, b.name AS b FROM names a JOIN names b ON a.block = b.block AND a.name <> b.name
  WHERE levenshtein(a.name, b.name) <= 1 AND len(list_distinct(a.places || b.places)) > 1
),
reached AS (
  SELECT block, name AS a, name AS b FROM names
  UNION
  SELECT r.block, r.a, l.b FROM reached r JOIN links l ON l.block = r.block AND l.a = r.b
),
roots AS (SELECT block, a AS name, min(b) AS root FROM reached GROUP BY block, a)
SELECT block, arg_min(name, struct_pack(p := priority, n := name)) AS name, count(*) AS n_records,
  count(DISTINCT priority) AS n_sources, count(DISTINCT name) AS n_names,
  {_survivor("brand")}, {_survivor("category")}, {_survivor("offer_price")}
FROM records JOIN roots USING (block, name) GROUP BY block, root""",
)

_HISTORY = with_versions(
    f"""SELECT code, nova_group, countries, CAST(ship_date AS varchar) AS effective_from,
  CAST(coalesce(lead(ship_date) OVER (PARTITION BY code ORDER BY ship_date), DATE '9999-12-31') AS varchar)
    AS effective_to,
  CASE WHEN lead(ship_date) OVER (PARTITION BY code ORDER BY ship_date) IS NULL THEN 1 ELSE 0 END AS is_current
FROM (
  SELECT *, lag(nova_group) OVER w AS nova_before, lag(countries) OVER w AS countries_before,
    row_number() OVER w AS position
  FROM (
    SELECT * FROM versions QUALIFY row_number() OVER (
      PARTITION BY code, ship_date ORDER BY {", ".join(f"{k} DESC" for k in TIE_BREAKERS)}) = 1
  ) WINDOW w AS (PARTITION BY code ORDER BY ship_date)
)
WHERE position = 1 OR nova_before IS DISTINCT FROM nova_group OR countries_before IS DISTINCT FROM countries"""
)
# Versions by a join on the interval; the event merge of the other side has no such join.
oracle(
    "fact_versions",
    f"""WITH history AS ({_HISTORY}),
facts AS ({with_snapshots('SELECT code, event_date, sugars_100g, nova_group FROM snapshots')})
SELECT f.code, CAST(strftime(f.event_date, '%Y%m%d') AS integer) AS time_sk, f.sugars_100g, f.nova_group,
  h.nova_group AS version_group, h.countries, h.effective_from
FROM facts f LEFT JOIN history h ON h.code = f.code AND f.event_date >= CAST(h.effective_from AS date)
  AND f.event_date < CAST(h.effective_to AS date)""",
)
oracle("scd2_history", _HISTORY)
oracle("scd2_extend", _HISTORY)

# The stored jobs give what the tables built directly give.
for _job, _direct in {
    "gold_job_products": "dim_product",
    "gold_job_bridge": "bridge_primary",
    "gold_job_fact": "fact_snapshot",
    "silver_job_metrics": "run_metrics",
    "report_brand_grade_share_laid_out": "report_brand_grade_share",
    "sources_csv": "union_of_sources",
    "sources_json": "union_of_sources",
    "sources_xml": "union_of_sources",
}.items():
    oracle(_job, ORACLE_SQL[_direct])
oracle(
    "load_counts",
    f"""SELECT table_name, n AS inserted,
  CASE WHEN table_name = 'fact_nutrition_snapshot'
       THEN (SELECT without_product + without_date FROM ({ORACLE_SQL["unresolved_facts"]})) ELSE 0 END AS rejected
FROM ({ORACLE_SQL["audit_counts"]})""",
)

# --- broken lines, documents of unlike shapes ---------------------------------------------------

_REASON = """case when l_orderkey % 11 = 0 then 'short' when l_orderkey % 11 = 1 then 'long'
  when l_orderkey % 11 in (2, 3) then 'quoting' end"""
oracle(
    "quarantine_lines",
    with_versions(
        f"""SELECT CASE WHEN reason IS NULL THEN code END AS code,
  CASE WHEN reason IS NULL THEN nullif(product_name, '') END AS product_name,
  CASE WHEN reason IS NULL THEN CASE WHEN l_orderkey % 11 = 4 THEN concat(chr(34), brands, chr(34), chr(9)) ELSE brands END END AS brands,
  CASE WHEN reason IS NULL THEN countries END AS countries,
  reason, CASE WHEN reason IS NOT NULL THEN line END AS line
FROM (SELECT *, {_REASON} AS reason, {DUMP_LINE} AS line FROM versions)"""
    ),
)
oracle(
    "sources_variant",
    """SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END, NULL FROM supplier""",
)
oracle(
    "sources_variant_fields",
    """SELECT f.name, f.type, n FROM (SELECT count(*) AS n FROM customer), (VALUES ('id', 'BIGINT'), ('segment', 'STRING'),
  ('party', 'OBJECT<home: OBJECT<nation: BIGINT>, names: ARRAY<STRING>>'), ('account', 'OBJECT<balance: DECIMAL>')) AS f(name, type)
UNION ALL
SELECT f.name, 'STRING', n FROM (SELECT count(*) AS n FROM supplier), (VALUES ('supplier_id'), ('title'), ('nation'), ('saldo')) AS f(name)""",
)

# --- category hierarchy -------------------------------------------------------------------------


def _parents(lists: str) -> str:
    """Most votes, none before others, then the smaller code; these data have no circles after the vote."""
    return f"""placed AS (
  SELECT codes[i] AS code, CASE WHEN i > 1 THEN codes[i - 1] END AS parent
  FROM (SELECT codes, unnest(range(1, len(codes) + 1)) AS i FROM {lists})
),
parents AS (
  SELECT code, parent FROM (SELECT code, parent, count(*) AS n FROM placed GROUP BY code, parent)
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY n DESC, parent NULLS FIRST) = 1
),
above AS (
  SELECT code, code AS ancestor, 0 AS distance FROM parents
  UNION ALL
  SELECT a.code, p.parent, a.distance + 1 FROM above a JOIN parents p ON p.code = a.ancestor WHERE p.parent IS NOT NULL
)"""


_LISTS = f"""lists AS (
  SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN list_reverse(codes) ELSE codes END AS codes
  FROM (SELECT p_partkey, p_size, list_filter([{", ".join(CATEGORY_LISTS.values())}], lambda x: x IS NOT NULL) AS codes FROM part)
)"""
oracle(
    "category_ancestors",
    f"WITH RECURSIVE {_LISTS}, {_parents('lists')} SELECT code, ancestor, distance FROM above",
)
oracle(
    "category_rollup",
    f"""WITH RECURSIVE {_LISTS}, {_parents('lists')},
lines AS (
  SELECT codes[len(codes)] AS leaf, l_returnflag, l_quantity::DECIMAL(18, 2) AS quantity
  FROM lineitem JOIN lists ON l_partkey = p_partkey
)
SELECT ancestor AS category, l_returnflag, count(*) AS n, sum(quantity)::DOUBLE AS quantity
FROM lines JOIN above ON code = leaf GROUP BY ancestor, l_returnflag""",
)

_SILVER_TREE = f"""WITH RECURSIVE {VERSIONS}, {PRODUCTS},
lists AS (
  SELECT list_filter(l, lambda x, i: x <> '' AND list_position(l, x) = i) AS codes
  FROM (SELECT list_transform(categories_codes, lambda x: {canonical("x")}) AS l FROM products)
),
{_parents("lists")},
levels AS (
  SELECT code AS category_code, (max(distance) + 1)::INTEGER AS level, any_value(p.parent) AS parent_code
  FROM above JOIN parents p USING (code) GROUP BY code
)"""
oracle("dim_category_hierarchy", f"{_SILVER_TREE} SELECT * FROM levels")
oracle(
    "audit_parent_categories",
    f"""{_SILVER_TREE} SELECT count(DISTINCT parent_code) AS n_parents, count(*) AS n_categories
FROM levels WHERE category_code <> 'promo' AND parent_code = 'promo'""",
)
