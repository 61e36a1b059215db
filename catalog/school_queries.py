"""Queries over school matching and the school dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import expression_queries as ex
from catalog import oracle_views as ov
from catalog import views
from catalog.registry import as_double, query
from gradeloom.functions import grades, names
from gradeloom.functions import registry as registry_cells
from gradeloom.operators import dimension, matching
from gradeloom.plans import loads, rows, years
from gradeloom.session import shared_folder
from gradeloom.sources.years import YearTable

# -- matching -----------------------------------------------------------------

_KEYS = f"""
keys AS (SELECT DISTINCT cod_judet AS county, {ov.match_key('nume', 'cod_judet')} AS key FROM source_schools),
own AS (SELECT *, alias = max(alias) OVER (PARTITION BY county, code) AS is_near FROM (
  SELECT DISTINCT cod_judet AS county, cod_siiir AS code, {ov.match_key('nume', 'cod_judet')} AS alias FROM institutions WHERE cod_siiir IS NOT NULL)),
official AS (SELECT DISTINCT judet_pj AS county, cod_siiir_unitate AS code, {ov.match_key('denumire_lunga_unitate', 'judet_pj')} AS alias
  FROM registry WHERE stare_liceal IS NOT NULL),
targets AS (SELECT county, code, alias, true AS is_primary, is_near FROM own
  UNION ALL SELECT official.*, false, true FROM official SEMI JOIN own USING (county, code)),
exact AS (SELECT county, min(key) AS key, code FROM (
  SELECT county, key, max(code) AS code FROM keys JOIN own USING (county) WHERE key = alias GROUP BY ALL) GROUP BY county, code)
"""


def keys_and_targets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    keys = matching.source_keys(views.source_schools(spark, sf), "nume", "cod_judet")
    return keys, matching.match_targets(views.institutions(spark, sf), views.registry(spark, sf))


@query("match_targets", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select="SELECT * FROM targets"))
def match_targets(spark: SparkSession, sf: str) -> DataFrame:
    return keys_and_targets(spark, sf)[1]


@query("exact_match", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select="SELECT * FROM exact"))
def exact_match(spark: SparkSession, sf: str) -> DataFrame:
    return matching.exact_matches(*keys_and_targets(spark, sf))


@query("equal_codes", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select="""
SELECT DISTINCT county, key, code, 0 AS dist FROM keys JOIN targets USING (county) WHERE key = alias"""))
def equal_codes(spark: SparkSession, sf: str) -> DataFrame:
    """All codes that have an alias equal to a key."""
    return matching.equal_codes(*keys_and_targets(spark, sf)).drop("cut")


@query("fuzzy_candidates", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select="""
SELECT county, key, min(d)::int AS dist, arg_min(code, (d, code)) AS code FROM (
  SELECT county, key, code, levenshtein(key, alias) AS d FROM keys JOIN targets USING (county))
WHERE d <= length(key) * 4 // 10 GROUP BY ALL"""))
def fuzzy_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest code of every key within four tenths of its length."""
    return matching.nearest_codes(*keys_and_targets(spark, sf), tenths=4, limit=1).select("county", "key", "dist", "code")


def _assigned(widest: int, first: int, high_school: bool) -> str:
    """Exact matches, then rounds of the near pairs: a recursion whose rows are the pairs still
    open (won is false) and those settled. A round without a winner leads to the next tier."""
    keys = _KEYS if high_school else _KEYS.replace("WHERE stare_liceal IS NOT NULL", "")
    views_ = ",".join(v.strip() for v in (ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, keys))
    return f"""WITH RECURSIVE {views_},
codeless AS (SELECT DISTINCT cod_judet AS county, {ov.match_key('nume', 'cod_judet')} AS key FROM institutions WHERE cod_siiir IS NULL),
asking AS (SELECT county, key FROM keys ANTI JOIN exact USING (county, key) ANTI JOIN codeless USING (county, key)),
free AS (SELECT county, code, alias FROM targets ANTI JOIN exact USING (county, code) WHERE is_near),
pairs AS MATERIALIZED (SELECT county, key, code, min(levenshtein(key, alias))::int AS dist FROM asking JOIN free USING (county)
  WHERE levenshtein(key, alias) <= length(key) * {widest} // 10 GROUP BY ALL),
r AS (
  SELECT {first} AS tier, county, key, code, dist, false AS won FROM pairs
  UNION ALL (
  WITH cur AS (SELECT * FROM r WHERE NOT won),
  asked AS (SELECT county, key, any_value(tier) AS tier, min((dist, code)) AS b FROM cur GROUP BY county, key),
  taken AS (SELECT county, b[2] AS code, any_value(tier) AS tier, min((b[1], key)) AS w FROM asked
    WHERE b[1] * 10 <= length(key) * tier GROUP BY county, b[2]),
  winners AS (SELECT tier, county, w[2] AS key, code, w[1] AS dist FROM taken)
  SELECT tier, county, key, code, dist, true FROM winners
  UNION ALL
  SELECT CASE WHEN EXISTS (SELECT 1 FROM winners) THEN tier ELSE tier + 1 END, county, key, code, dist, false
  FROM cur ANTI JOIN winners USING (county, key) ANTI JOIN winners w2 USING (county, code)
  WHERE tier < {widest} OR EXISTS (SELECT 1 FROM winners)))
SELECT county, key, code, 0 AS dist, NULL::int AS tier FROM exact
UNION ALL SELECT county, key, code, dist, tier FROM r WHERE won"""


@query("fuzzy_match", _assigned(4, 1, True))
def fuzzy_match(spark: SparkSession, sf: str) -> DataFrame:
    """One-to-one assignment, exact and then by tiers."""
    return matching.match_schools(
        views.source_schools(spark, sf), "nume", "cod_judet", views.institutions(spark, sf), views.registry(spark, sf)
    )


@query("equal_match", _assigned(0, 0, False))
def equal_match(spark: SparkSession, sf: str) -> DataFrame:
    """The same in middle-school mode: equal names only, of all schools of the registry."""
    return matching.match_schools(
        views.source_schools(spark, sf), "nume", "cod_judet", views.institutions(spark, sf), views.registry(spark, sf), high_school=False
    )


@query("placement_codes", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select=f"""
SELECT p.id, p.nume, p.cod_judet, e.code
FROM (SELECT id, CASE WHEN id % 9 <> 0 THEN nume END AS nume, cod_judet FROM institutions) p
LEFT JOIN exact e ON e.county = p.cod_judet AND e.key = {ov.match_key('p.nume', 'p.cod_judet')}"""))
def placement_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Write-back of placement schools: the old code always goes, null where nothing matches."""
    matches = matching.exact_matches(*keys_and_targets(spark, sf))
    facts = views.institutions(spark, sf).select(
        "id", F.when(F.col("id") % 9 != 0, F.col("nume")).alias("nume"), "cod_judet", F.lit("old").alias("code")
    )
    return matching.attach_codes(facts, matches, "nume", "cod_judet", "code", only_missing=False)


@query("matched_codes", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select=f"""
SELECT p.id, p.nume, p.cod_judet, coalesce(CASE WHEN p.id % 7 = 0 THEN 'own' END, e.code) AS code
FROM institutions p LEFT JOIN exact e ON e.county = p.cod_judet AND e.key = {ov.match_key('p.nume', 'p.cod_judet')}"""))
def matched_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Exact matches written back to rows that have no code yet."""
    matches = matching.exact_matches(*keys_and_targets(spark, sf))
    facts = views.institutions(spark, sf).select(
        "id", "nume", "cod_judet", F.when(F.col("id") % 7 == 0, "own").alias("code")
    )
    return matching.attach_codes(facts, matches, "nume", "cod_judet", "code")


@query("unmatched_schools", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, _KEYS, select="""
SELECT county, key FROM keys ANTI JOIN exact USING (county, key)"""))
def unmatched_schools(spark: SparkSession, sf: str) -> DataFrame:
    matches = matching.exact_matches(*keys_and_targets(spark, sf))
    return matching.unmatched_schools(views.source_schools(spark, sf), "nume", "cod_judet", matches)


_NUMBERED_NAME = "concat('Școala Nr. ', regexp_extract(nume, 'Nr. ([0-9]+)$', 1))"


@query("code_backfill", ov.sql(ov.INSTITUTIONS, select=f"""
, renamed AS (SELECT id, cod_judet, cod_siiir, {_NUMBERED_NAME} AS nume FROM institutions),
named AS (SELECT *, {ov.canonical_id('nume', 'cod_judet')} AS cid, {ov.match_key('nume', 'cod_judet')} AS key FROM renamed),
coded AS (SELECT cod_judet AS county, key, max(CASE WHEN id % 2 = 0 THEN cod_siiir ELSE '9' || substr(cod_siiir, 2) END) AS code
  FROM named WHERE cod_siiir IS NOT NULL GROUP BY ALL),
found AS (SELECT county, min(key) AS key, code FROM coded GROUP BY county, code),
owners AS (SELECT cod_siiir AS code, min(cid) AS owner FROM named WHERE cod_siiir IS NOT NULL GROUP BY ALL)
SELECT cid AS id, nume, code, owner, owner IS NULL AS accepted
FROM named n JOIN found f ON f.county = n.cod_judet AND f.key = n.key LEFT JOIN owners USING (code) WHERE cod_siiir IS NULL"""))
def code_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Institutions without a code that share a name with coded ones; half of the codes found
    belong to nobody and are accepted. Schools are named by their number, so many share a name."""
    renamed = views.institutions(spark, sf).withColumn("nume", F.expr(_NUMBERED_NAME))
    schools = renamed.withColumn("n", F.col("id")).withColumn("id", names.canonical_id("nume", "cod_judet"))
    other = F.concat(F.lit("9"), F.expr("substr(cod_siiir, 2)"))
    targets = matching.match_targets(
        schools.withColumn("cod_siiir", F.when(F.col("n") % 2 == 0, F.col("cod_siiir")).otherwise(other))
    )
    keys = matching.source_keys(schools, "nume", "cod_judet")
    return matching.backfill_codes(schools, matching.exact_matches(keys, targets))


# -- dimension ----------------------------------------------------------------

_NAMED = """
spellings AS (SELECT unitate_siiir AS cod_siiir, unitate_nume AS nume, unitate_cod_judet AS cod_judet, count(*) AS n
  FROM results WHERE unitate_siiir IS NOT NULL GROUP BY ALL),
named AS (SELECT *, count(*) OVER (PARTITION BY cod_siiir) AS variants,
  row_number() OVER (PARTITION BY cod_siiir ORDER BY n DESC, nume DESC, cod_judet DESC) AS rn FROM spellings)
"""


_NUMBER = "cast(substr(cod_siiir, 6, length(cod_siiir) - 6) AS int)"


def result_schools(spark: SparkSession, sf: str) -> DataFrame:
    """Schools of the results by code, as a dimension in which some names differ."""
    named = dimension.school_names(views.candidates(spark, sf)).drop("variants")
    other = F.concat(F.lit("Grup "), "nume")
    return named.withColumn("nume", F.when(F.expr(_NUMBER) % 3 == 0, other).otherwise(F.upper("nume")))


_SCHOOLS = f"""
schools AS (SELECT cod_siiir, CASE WHEN {_NUMBER} % 3 = 0 THEN 'Grup ' || nume ELSE upper(nume) END AS nume, cod_judet
  FROM named WHERE rn = 1)
"""


@query("missing_schools", ov.sql(ov.RESULTS, _NAMED, _SCHOOLS, select=f"""
SELECT cod_siiir, nume, cod_judet, variants, {ov.display_name('nume')} AS nume_afisat FROM named
WHERE rn = 1 AND cod_siiir NOT IN (SELECT cod_siiir FROM schools WHERE {_NUMBER} % 5 <> 0)"""))
def missing_schools(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth school is missing from the dimension."""
    return dimension.missing_schools(views.candidates(spark, sf), result_schools(spark, sf).filter(F.expr(_NUMBER) % 5 != 0))


@query("unused_schools", ov.sql(ov.RESULTS, ov.INSTITUTIONS, select="""
SELECT id, cod_siiir, CASE WHEN cod_siiir IS NOT NULL THEN EXISTS (SELECT 1 FROM results r WHERE r.unitate_siiir = cod_siiir) END AS used
FROM institutions"""))
def unused_schools(spark: SparkSession, sf: str) -> DataFrame:
    codes = views.candidates(spark, sf).select("unitate_siiir").distinct()
    return dimension.unused_schools(views.institutions(spark, sf), codes).select("id", "cod_siiir", "used")


@query("kept_schools", ov.sql(ov.RESULTS, ov.INSTITUTIONS, select="""
SELECT id, cod_siiir FROM institutions WHERE cod_siiir IS NULL OR EXISTS (SELECT 1 FROM results r WHERE r.unitate_siiir = cod_siiir)"""))
def kept_schools(spark: SparkSession, sf: str) -> DataFrame:
    codes = views.candidates(spark, sf).select("unitate_siiir").distinct()
    return dimension.drop_unused_schools(views.institutions(spark, sf), codes).select("id", "cod_siiir")


@query("name_drift", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, select=f"""
, official AS (SELECT cod_siiir_unitate AS code, max((denumire_lunga_unitate, judet_pj)) AS o FROM registry
  GROUP BY ALL),
drifting AS (SELECT id, cod_judet, cod_siiir, CASE WHEN id % 3 = 0 THEN replace(nume, 'Nr.', 'Numarul') ELSE nume END AS nume FROM institutions),
judged AS (SELECT id, nume, o[1] AS nume_registru, CASE WHEN o IS NULL THEN 'missing'
  WHEN {ov.fold_key('nume', 'cod_judet')} = {ov.fold_key('o[1]', 'o[2]')} THEN 'same' ELSE 'different' END AS status
  FROM drifting LEFT JOIN official ON code = cod_siiir)
SELECT id, nume, nume_registru, status, CASE WHEN status = 'different' THEN {ov.display_name('nume_registru')} END AS nume_nou
FROM judged"""))
def name_drift(spark: SparkSession, sf: str) -> DataFrame:
    renamed = F.replace("nume", F.lit("Nr."), F.lit("Numarul"))
    schools = views.institutions(spark, sf).withColumn("nume", F.when(F.col("id") % 3 == 0, renamed).otherwise(F.col("nume")))
    return dimension.name_drift(schools, views.registry(spark, sf)).select("id", "nume", "nume_registru", "status", "nume_nou")


@query("name_drift_applied", ov.sql(ov.RESULTS, _NAMED, _SCHOOLS, select=f"""
SELECT s.cod_siiir, s.cod_judet, CASE WHEN starts_with(s.nume, 'Grup') THEN {ov.display_name('n.nume')} ELSE s.nume END AS nume,
  starts_with(s.nume, 'Grup') AS renamed FROM schools s JOIN named n ON n.rn = 1 AND n.cod_siiir = s.cod_siiir"""))
def name_drift_applied(spark: SparkSession, sf: str) -> DataFrame:
    changed = dimension.apply_name_drift(result_schools(spark, sf), views.candidates(spark, sf))
    return changed.select("cod_siiir", "cod_judet", "nume", "renamed")


@query("two_registry_lookup", ov.sql(ov.OLD_REGISTRIES, ov.COUNTIES, select="""
, a AS (SELECT cast(cod_siiir AS bigint) AS code, max((nr_crt, nume_unitate, judet)) AS v FROM first_registry GROUP BY ALL),
b AS (SELECT cast(cod_sirues AS bigint) AS code, max((nr_crt, nume_unitate, judet)) AS v FROM second_registry GROUP BY ALL),
found AS (SELECT o_orderkey AS id, coalesce(a.v, b.v) AS v FROM (SELECT o_orderkey, o_custkey AS c FROM orders) o
  LEFT JOIN a ON a.code = c LEFT JOIN b ON b.code = c)
SELECT id, any_value(v[2]) AS liceu, arg_min(counties.code, pos) AS judet, any_value(v) IS NOT NULL AS code_known
FROM found LEFT JOIN counties ON contains(upper(strip_accents(v[3])), plain) GROUP BY id"""))
def two_registry_lookup(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("o_custkey")
    facts = views.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), views.padded(code, 7).alias("siiir"), code.cast("string").alias("sirues")
    )
    first, second = views.old_registries(spark, sf)
    return dimension.two_registry_lookup(facts, first, second).select("id", "liceu", "judet", "code_known")


_CORRECTIONS = "corrections AS (SELECT DISTINCT l_orderkey AS ord FROM lineitem WHERE l_quantity = 50 UNION SELECT -1)"


def corrections(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates whose order has a line of 50 pieces; may repeat."""
    listed = views.table(spark, sf, "lineitem").filter("l_quantity = 50").select(F.col("l_orderkey").alias("ord"))
    return views.candidates(spark, sf).join(listed, "ord").select("an", "cod_candidat")


@query("corrections", ov.sql(ov.RESULTS, _CORRECTIONS, select="""
SELECT an, cod_candidat, CASE WHEN c.ord IS NULL THEN unitate_siiir END AS unitate_siiir,
  CASE WHEN c.ord IS NULL THEN unitate_nume END AS unitate_nume, CASE WHEN c.ord IS NULL THEN unitate_cod_judet END AS unitate_cod_judet
FROM results r LEFT JOIN corrections c USING (ord)"""))
def corrected(spark: SparkSession, sf: str) -> DataFrame:
    facts = views.candidates(spark, sf)
    return dimension.correct_assignments(facts, corrections(spark, sf)).select(
        "an", "cod_candidat", "unitate_siiir", "unitate_nume", "unitate_cod_judet"
    )


@query("correction_counts", ov.sql(ov.RESULTS, _CORRECTIONS, select="""
SELECT an, cod_candidat, CASE WHEN ord % 2 = 0 THEN 1 ELSE 0 END::bigint AS "rows" FROM results JOIN corrections USING (ord)"""))
def correction_counts(spark: SparkSession, sf: str) -> DataFrame:
    facts = views.candidates(spark, sf).filter(F.col("ord") % 2 == 0)
    return dimension.correction_counts(facts, corrections(spark, sf))


_RESOLVED = """
walk AS (SELECT alternativ, corect, 1 AS depth FROM aliases
  UNION ALL SELECT w.alternativ, a.corect, depth + 1 FROM walk w JOIN aliases a ON a.alternativ = w.corect),
resolved AS (SELECT alternativ, arg_max(corect, depth) AS corect FROM walk GROUP BY ALL)
"""


@query("alias_chains", "WITH RECURSIVE " + ",".join(v.strip() for v in (ov.ALIASES, _RESOLVED)) + " SELECT * FROM resolved")
def alias_chains(spark: SparkSession, sf: str) -> DataFrame:
    return dimension.resolve_aliases(views.alias_pairs(spark, sf))


@query("alias_remap", "WITH RECURSIVE " + ",".join(v.strip() for v in (ov.ALIASES, _RESOLVED)) + """
SELECT o_orderkey AS ord, coalesce(corect, cast(o_custkey AS string)) AS id FROM orders
LEFT JOIN resolved ON alternativ = cast(o_custkey AS string)""")
def alias_remap(spark: SparkSession, sf: str) -> DataFrame:
    facts = views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("ord"), F.col("o_custkey").cast("string").alias("id"))
    return dimension.remap_ids(facts, dimension.resolve_aliases(views.alias_pairs(spark, sf)), "id")


@query("alias_rows_dropped", ov.sql(ov.ALIASES, select="""
SELECT cast(c_custkey AS string) AS id, c_mktsegment AS nume FROM customer
WHERE cast(c_custkey AS string) NOT IN (SELECT alternativ FROM aliases)"""))
def alias_rows_dropped(spark: SparkSession, sf: str) -> DataFrame:
    schools = views.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("nume"))
    return dimension.drop_alias_rows(schools, views.alias_pairs(spark, sf))


@query("unified_dimension", """
SELECT c_custkey AS id, c_name AS nume, c_custkey % 50 AS rank FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, c_mktsegment, NULL FROM customer WHERE c_custkey % 2 <> 0""")
def unified_dimension(spark: SparkSession, sf: str) -> DataFrame:
    customer, key = views.table(spark, sf, "customer"), F.col("c_custkey")
    high = customer.filter(key % 2 == 0).select(key.alias("id"), F.col("c_name").alias("nume"), (key % 50).alias("rank"))
    middle = customer.filter((key % 3 == 0) | (key % 2 != 0)).select(key.alias("id"), F.col("c_mktsegment").alias("nume"), F.lit("x").alias("cod_siiir"))
    return dimension.unify_dimensions(high, middle)


@query("codes_by_id", ov.sql(ov.COUNTIES, select=f"""
, reg AS (SELECT p_partkey, p_name || ' ' || p_type AS denumire, {ov.county_text('p_partkey')} AS judet,
  CASE WHEN p_partkey % 3 = 0 THEN 'Altceva' ELSE 'Unitate de învățământ' END AS tip, cast(p_partkey AS string) AS cod FROM part),
coded AS (SELECT p_partkey, any_value(denumire) AS denumire, any_value(tip) AS tip, any_value(cod) AS cod, arg_min(code, pos) AS county
  FROM reg JOIN counties ON contains(upper(strip_accents(judet)), plain) GROUP BY p_partkey),
ids AS (SELECT *, {ov.canonical_id('denumire', 'county', False)} AS id FROM coded),
found AS (SELECT id, max(cod) AS cod FROM ids WHERE tip <> 'Altceva' GROUP BY ALL)
SELECT id, coalesce(f.cod, i.old) AS cod_siiir FROM (SELECT id, max('vechi ' || cod) AS old FROM ids GROUP BY ALL) i LEFT JOIN found f USING (id)"""))
def codes_by_id(spark: SparkSession, sf: str) -> DataFrame:
    part, key = views.table(spark, sf, "part"), F.col("p_partkey")
    registry = part.select(
        F.concat("p_name", F.lit(" "), "p_type").alias("denumire"), views.county_text(key).alias("judet"),
        F.when(key % 3 == 0, "Altceva").otherwise("Unitate de învățământ").alias("tip_unitate"), key.cast("string").alias("cod"),
    )
    school_id = names.canonical_id("denumire", names.county_from_text("judet"), place_rules=False)
    schools = registry.groupBy(school_id.alias("id")).agg(F.max(F.concat(F.lit("vechi "), "cod")).alias("cod_siiir"))
    return dimension.codes_by_id(schools, registry)


@query("attribute_backfill", ov.sql(ov.DETAILS, ov.LISTED, select="""
SELECT l.id, l.cod_siiir, coalesce(nullif(l.adresa, ''), CASE WHEN d.cod IS NOT NULL THEN
    trim(strada, ' ,.') || CASE WHEN trim(nr_strada) IN ('', '-', '.', 'x') THEN '' ELSE ' ' || trim(nr_strada, ' ,.') END
    || coalesce(', ' || array_to_string(list_transform(regexp_extract_all(localitate, '\\p{L}+|[^\\p{L}]+'), lambda w:
       upper(substr(w, 1, 1)) || lower(substr(w, 2))), ''), '') || coalesce(', ' || cod_postal, '') END, l.adresa) AS adresa,
  coalesce(nullif(l.website, ''), nullif(d.website, ''), l.website) AS website, coalesce(nullif(d.telefon, ''), l.telefon) AS telefon,
  coalesce(d.cod_fiscal, l.cod_fiscal) AS cod_fiscal
FROM listed l LEFT JOIN details d ON d.cod = l.cod_siiir"""))
def attribute_backfill(spark: SparkSession, sf: str) -> DataFrame:
    filled = dimension.backfill_attributes(views.listed_schools(spark, sf), views.school_details(spark, sf))
    return filled.select("id", "cod_siiir", "adresa", "website", "telefon", "cod_fiscal")


@query("membership_flags", """
SELECT c_custkey AS id, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS gimnaziu,
  EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%') AS liceu FROM customer""")
def membership_flags(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders").withColumnRenamed("o_custkey", "id")
    schools = views.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return dimension.membership_flags(
        schools, orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderpriority like '1%'")
    )


_FILES = """
files AS (SELECT 'S' || cast(o_custkey AS string) || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '_' || cast(o_orderkey AS string) END
  || CASE o_orderkey % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.webp' WHEN 2 THEN '.svg' ELSE '.txt' END AS file_name FROM orders),
owned AS (SELECT DISTINCT file_name, regexp_extract(file_name, '^(S[0-9]+)(_[0-9]+)?\\.(png|webp|svg)', 1) AS id FROM files
  WHERE regexp_matches(file_name, '\\.(png|webp|svg)'))
"""


def stored_files(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    number = F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("_"), key.cast("string")))
    suffix = F.when(key % 4 == 0, ".png").when(key % 4 == 1, ".webp").when(key % 4 == 2, ".svg").otherwise(".txt")
    name = F.concat(F.lit("S"), F.col("o_custkey").cast("string"), number, suffix)
    return views.table(spark, sf, "orders").select(name.alias("file_name"))


def _numbered_schools(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    return views.table(spark, sf, "customer").select(F.concat(F.lit("S"), key).alias("id"))


@query("file_attach", ov.sql(_FILES, select="""
SELECT id, sigla, sigla_xs IS NOT NULL AS sigla_xs FROM (SELECT 'S' || cast(c_custkey AS string) AS id FROM customer)
LEFT JOIN (SELECT id, min(file_name) AS sigla, min(CASE WHEN file_name LIKE '%.png' THEN 1 END) AS sigla_xs FROM owned GROUP BY id) USING (id)"""))
def file_attach(spark: SparkSession, sf: str) -> DataFrame:
    files = stored_files(spark, sf)
    small = files.filter(F.col("file_name").endswith(".png"))
    return dimension.attach_files(_numbered_schools(spark, sf), files, small)


@query("many_files", ov.sql(_FILES, select="""
SELECT id, count(*) AS n FROM owned JOIN customer ON 'S' || cast(c_custkey AS string) = id GROUP BY id HAVING count(*) > 1"""))
def many_files(spark: SparkSession, sf: str) -> DataFrame:
    return dimension.schools_with_many_files(_numbered_schools(spark, sf), stored_files(spark, sf))


@query("display_name_fill", ov.sql(ov.LISTED, select=f"""
SELECT id, CASE WHEN id % 4 = 0 THEN 'Existing' WHEN id % 3 = 0 THEN 'Twin ' || id ELSE {ov.display_name('nume')} END AS nume_afisat
FROM listed"""))
def display_name_fill(spark: SparkSession, sf: str) -> DataFrame:
    schools = views.listed_schools(spark, sf).select("id", "nume", F.when(F.col("id") % 4 == 0, "Existing").alias("nume_afisat"))
    twins = schools.filter(F.col("id") % 3 == 0).select("id", F.concat(F.lit("Twin "), "id").alias("nume_afisat"))
    return dimension.fill_display_names(schools, twins).select("id", "nume_afisat")


def _batch_schools(spark: SparkSession, sf: str) -> DataFrame:
    orders = views.table(spark, sf, "orders")
    return orders.select(
        F.concat(F.lit("S"), (F.col("o_custkey") + 500).cast("string")).alias("id"), F.col("o_orderpriority").alias("nume"),
        F.col("o_orderstatus").alias("cod_siiir"), "o_orderkey",
    )


_GROWN = """
batch AS (SELECT 'S' || cast(o_custkey + 500 AS string) AS id, arg_min(o_orderpriority, o_orderkey) AS nume,
  arg_min(o_orderstatus, o_orderkey) AS cod_siiir FROM orders GROUP BY ALL),
dim AS (SELECT 'S' || cast(c_custkey AS string) AS id, c_mktsegment AS nume, 'old' AS cod_siiir FROM customer)
"""


def _dimension(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "customer").select(
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_mktsegment").alias("nume"),
        F.lit("old").alias("cod_siiir"),
    )


@query("grown_dimension", ov.sql(_GROWN, select="""
SELECT coalesce(b.id, d.id) AS id, coalesce(b.nume, d.nume) AS nume, coalesce(b.cod_siiir, d.cod_siiir) AS cod_siiir
FROM dim d FULL JOIN batch b ON b.id = d.id"""))
def grown_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return dimension.grow_dimension(_dimension(spark, sf), _batch_schools(spark, sf), ["o_orderkey"])


@query("grown_dimension_insert", ov.sql(_GROWN, select=f"""
SELECT coalesce(d.id, b.id) AS id, CASE WHEN d.id IS NULL THEN {ov.display_name('b.nume')} ELSE d.nume END AS nume, d.cod_siiir
FROM dim d FULL JOIN batch b ON b.id = d.id"""))
def grown_dimension_insert(spark: SparkSession, sf: str) -> DataFrame:
    return dimension.grow_dimension(_dimension(spark, sf), _batch_schools(spark, sf), ["o_orderkey"], insert_only=True)


@query("coordinates", """
SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'known' WHEN c_custkey % 2 = 0
  THEN cast(c_nationkey AS string) || ',' || cast(c_custkey % 90 AS string) END AS longlat FROM customer""")
def coordinates(spark: SparkSession, sf: str) -> DataFrame:
    customer, key = views.table(spark, sf, "customer"), F.col("c_custkey")
    schools = customer.select(key.alias("id"), F.when(key % 3 == 0, "known").alias("longlat"))
    points = customer.filter(key % 2 == 0).select(key.alias("id"), F.col("c_nationkey").alias("long"), (key % 90).alias("lat"))
    return dimension.fill_coordinates(schools, points)


# -- older loads --------------------------------------------------------------

_OLD_MARK = """CASE WHEN regexp_matches({0}, '^[0-9.]+$') THEN cast({0} AS double) END"""


@query("old_bac_rows", ov.sql(ov.RESULTS, ov.OLD_REGISTRIES, ov.COUNTIES, select=f"""
, num AS (SELECT *, {_OLD_MARK.format('lr_init')} AS lr_i, {_OLD_MARK.format('lr_cont')} AS lr_c, {_OLD_MARK.format('lm_init')} AS lm_f,
  {_OLD_MARK.format('do_init')} AS do_i, {_OLD_MARK.format('do_cont')} AS do_c, {_OLD_MARK.format('da_init')} AS da_i,
  {_OLD_MARK.format('da_cont')} AS da_c, ord // 20 AS c FROM results),
a AS (SELECT cast(cod_siiir AS bigint) AS code, max((nr_crt, nume_unitate, judet)) AS v FROM first_registry GROUP BY ALL),
b AS (SELECT cast(cod_sirues AS bigint) AS code, max((nr_crt, nume_unitate, judet)) AS v FROM second_registry GROUP BY ALL),
county_of AS (SELECT j AS judet, arg_min(code, pos) AS county FROM (SELECT DISTINCT judet AS j FROM first_registry UNION SELECT judet FROM second_registry)
  JOIN counties ON contains(upper(strip_accents(j)), plain) GROUP BY j),
found AS (SELECT num.*, coalesce(a.v, b.v) AS v FROM num LEFT JOIN a ON a.code = c LEFT JOIN b ON b.code = c),
named AS (SELECT *, v[2] AS liceu, coalesce(lr_c, lr_i) AS lr, coalesce(do_c, do_i) AS dof, coalesce(da_c, da_i) AS da,
  CASE rezultat WHEN 'REUSIT' THEN 'REUSIT' WHEN 'Respins' THEN 'RESPINS' WHEN 'Neprezentat' THEN 'ABSENT'
    WHEN 'Eliminat din examen' THEN 'ELIMINAT' END AS label FROM found LEFT JOIN county_of ON judet = v[3])
SELECT an, cod_candidat, county AS id_judet, {ov.canonical_id('liceu', 'county', False)} AS id_liceu,
  CASE WHEN {ov.EARLIER} THEN 'DA' ELSE 'NU' END AS promotie_anterioara, lr AS lr_final, lm_f AS lm_final, dof AS do_final, da AS da_final,
  CASE WHEN label IN ('REUSIT', 'RESPINS') THEN (lr + dof + da + coalesce(lm_f, 0)) / CASE WHEN lm_f IS NULL THEN 3 ELSE 4 END END AS my_medie,
  label AS rezultat, CASE WHEN label IS NULL THEN 'label' ELSE '' END AS why FROM named"""))
def old_bac_rows(spark: SparkSession, sf: str) -> DataFrame:
    code = F.floor(F.col("ord") / 20)
    number = {f"{s}_initial": F.col(f"{s}_init").try_cast("double") for s in ("lr", "lm", "do", "da")}
    appeal = {f"{s}_contestatie": F.col(f"{s}_cont").try_cast("double") for s in ("lr", "do", "da")}
    records = views.results(spark, sf).withColumns({
        **number, **appeal, "lm_contestatie": F.lit(None).cast("double"), "siiir": views.padded(code, 7),
        "sirues": code.cast("string"), "specializare": F.lit(None).cast("string"), "limba_straina": F.lit(None).cast("string"),
        "disciplina_obligatorie": F.lit(None).cast("string"), "disciplina_la_alegere": F.lit(None).cast("string"),
        "medie": F.lit(None).cast("double"), "rezultat_final": F.col("rezultat"),
    })
    first, second = views.old_registries(spark, sf)
    df = rows.old_bac_rows(records, F.col("an"), first, second)
    return df.select(
        "an", "cod_candidat", "id_judet", "id_liceu", "promotie_anterioara", "lr_final", "lm_final", "do_final", "da_final",
        "my_medie", "rezultat", F.array_join("reject_reasons", ",").alias("why"),
    )


def old_en_records(spark: SparkSession, sf: str) -> DataFrame:
    return views.results(spark, sf).select(
        "an", "ord", F.col("cod_candidat").alias("name"), F.col("unitate_cod_judet").alias("county"),
        F.col("unitate_nume").alias("school"), F.col("unitate_siiir").alias("schoolCode"),
        F.col("lr_init").alias("ri"), F.nullif("lr_cont", F.lit("")).alias("rf"), F.col("do_init").alias("mi"),
        F.nullif("do_cont", F.lit("")).alias("mf"), F.col("limba_materna").alias("lmp"), F.col("lm_init").alias("lmi"),
        F.lit(None).cast("string").alias("lmf"), F.col("da_init").alias("mev"),
    )


_OLD_EN = f"""
old_en AS (SELECT an, cod_candidat, unitate_cod_judet AS id_judet, {ov.canonical_id('unitate_nume', 'unitate_cod_judet', False)} AS id_scoala,
  {ov.canonical_name('unitate_nume')} AS nume_scoala, unitate_siiir AS cod_siiir, lr AS lr_final, dob AS ma_final,
  nullif(limba_materna, '-') AS limba_materna, lm_f AS lm_final, da_i AS medie_en, da_i AS medie_adm, ord FROM finals)
"""


@query("old_en_rows", ov.sql(ov.RESULTS, ov.MARKS, _OLD_EN, select="""
SELECT an, cod_candidat, id_judet, id_scoala, cod_siiir, lr_final, ma_final, limba_materna, lm_final, medie_en, medie_adm FROM old_en"""))
def old_en_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = rows.old_en_rows(old_en_records(spark, sf), F.col("an"))
    return df.select(
        "an", "cod_candidat", "id_judet", "id_scoala", "cod_siiir", *as_double("lr_final", "ma_final"), "limba_materna",
        *as_double("lm_final", "medie_en", "medie_adm"),
    )


@query("old_en_site_rows", ov.sql(ov.RESULTS, ov.MARKS, _OLD_EN, select="""
SELECT an, cod_candidat, id_judet, id_scoala, lr_final, ma_final, limba_materna, lm_final, medie_en FROM old_en"""))
def old_en_site_rows(spark: SparkSession, sf: str) -> DataFrame:
    records = views.results(spark, sf).select(
        "an", "cod_candidat", F.col("unitate_nume").alias("scoala"), F.col("lr_init").alias("lri"), F.col("lr_cont").alias("lrf"),
        F.col("do_init").alias("mi"), F.col("do_cont").alias("mf"), "limba_materna", F.col("lm_init").alias("lmi"),
        F.lit(None).cast("string").alias("lmf"), F.col("da_init").alias("medie"),
    )
    return rows.old_en_site_rows(records, F.col("an")).select(
        "an", "cod_candidat", "id_judet", "id_scoala", *as_double("lr_final", "ma_final"), "limba_materna",
        *as_double("lm_final", "medie_en"),
    )


def old_placement_records(spark: SparkSession, sf: str) -> DataFrame:
    return views.results(spark, sf).select(
        "an", "ord", F.col("cod_candidat").alias("n"), views.county_text(F.col("ord")).alias("jp"), F.col("unitate_nume").alias("s"),
        F.col("unitate_siiir").alias("sc"), F.col("lr_init").alias("nro"), F.col("do_init").alias("nmate"),
        F.col("limba_materna").alias("lm"), F.col("lm_init").alias("nlm"), F.col("da_init").alias("mev"), F.col("do_cont").alias("mabs"),
        F.col("lr_cont").alias("madm"), F.col("repartizat_liceu_nume").alias("h"), F.col("repartizat_specializare").alias("sp"),
        F.col("unitate_cod_judet").alias("ja"),
    )


_COUNTY_BY_NUMBER = f"""
county_of AS (SELECT i, arg_min(code, pos) AS county FROM (SELECT i, {ov.county_text('i')} AS txt FROM range(42) r(i))
  JOIN counties ON contains(upper(strip_accents(txt)), plain) GROUP BY i)
"""
_PLACED_SCHOOL = "replace(replace(split_part(repartizat_liceu_nume, '<br/>', 1), '<b>', ''), '</b>', '')"
_OLD_TRACK = """regexp_replace(replace(replace(split_part(s, '<br/>', 1), '<b>', ''), '</b>', ''), '^[() 0-9]+', '')
    || CASE WHEN contains(split_part(s, '<br/>', 2), '/') THEN ' (' || split_part(split_part(s, '<br/>', 2), '/', -1) || ')' ELSE '' END"""


@query("old_placement_rows", ov.sql(ov.RESULTS, ov.MARKS, ov.COUNTIES, _COUNTY_BY_NUMBER, select=f"""
SELECT an, cod_candidat, county AS id_judet, {ov.canonical_id('unitate_nume', 'county', False)} AS id_scoala, lr_i AS lr_final, do_i AS ma_final,
  da_i AS medie_en, do_c AS medie_abs, lr_c AS medie_adm,
  CASE WHEN repartizat_liceu_nume <> '' THEN {ov.canonical_id(_PLACED_SCHOOL, 'unitate_cod_judet', False)} END AS repartizat_id_liceu,
  CASE WHEN repartizat_liceu_nume <> '' THEN {_OLD_TRACK} END AS repartizat_specializare
FROM (SELECT *, repartizat_specializare AS s FROM finals) JOIN county_of ON i = ord % 42"""))
def old_placement_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rows.old_placement_rows(old_placement_records(spark, sf), F.col("an")).select(
        "an", "cod_candidat", "id_judet", "id_scoala",
        *as_double("lr_final", "ma_final", "medie_en", "medie_abs", "medie_adm"), "repartizat_id_liceu", "repartizat_specializare",
    )


@query("old_en_merge", ov.sql(ov.RESULTS, ov.MARKS, ov.COUNTIES, _COUNTY_BY_NUMBER, _OLD_EN, select="""
SELECT e.an, e.cod_candidat, e.id_scoala, e.lr_final, f.da_i AS medie_en, f.do_c AS medie_abs, f.lr_c AS medie_adm, false AS is_new
FROM old_en e JOIN finals f USING (ord)"""))
def old_en_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Placement merged into the exam rows: known candidates change in five columns only."""
    base = rows.old_en_rows(old_en_records(spark, sf), F.col("an"), keep=["ord"]).drop("nume_scoala", "cod_siiir", "ord")
    batch = rows.old_placement_rows(old_placement_records(spark, sf), F.col("an"), keep=["ord"])
    schools = batch.filter(F.lit(False)).select(F.col("id_scoala").alias("id"), F.col("nume_scoala").alias("nume"), "cod_siiir")
    facts, _ = loads.old_en_year(base, batch, schools, ["ord"], update=True)
    return facts.select(
        "an", "cod_candidat", "id_scoala", *as_double("lr_final", "medie_en", "medie_abs", "medie_adm"), "is_new"
    )


@query("old_admission_update", ov.sql(ov.RESULTS, ov.MARKS, ov.COUNTIES, _COUNTY_BY_NUMBER, select=f"""
SELECT an, cod_candidat, CASE WHEN ord % 7 <> 0 THEN do_c END AS medie_abs, CASE WHEN ord % 7 <> 0 THEN lr_c ELSE lr_i END AS medie_adm,
  CASE WHEN ord % 7 <> 0 AND repartizat_liceu_nume <> '' THEN {ov.canonical_id("split_part(repartizat_liceu_nume, '<br/>', 1)", 'county', False)} END AS repartizat_id_liceu
FROM finals JOIN county_of ON i = ord % 42"""))
def old_admission_update(spark: SparkSession, sf: str) -> DataFrame:
    """Admission rows of all years for six sevenths of the candidates."""
    results = views.results(spark, sf)
    none = F.lit(None)
    base = results.select(
        "an", "cod_candidat", none.cast("decimal(12,2)").alias("medie_abs"), grades.parse_grade("lr_init", upper=None).alias("medie_adm"),
        none.cast("string").alias("repartizat_id_liceu"), none.cast("string").alias("repartizat_specializare"),
    )
    records = results.filter(F.col("ord") % 7 != 0).select(
        "an", "cod_candidat", "ord", views.county_text(F.col("ord")).alias("judet"), F.col("do_cont").alias("mabs"), F.col("lr_cont").alias("madm"),
        "repartizat_liceu_nume", "repartizat_specializare",
    )
    batch = rows.old_admission_rows(records, keep=["an", "ord"])
    return loads.old_admission_update(base, batch, None, ["ord"]).select(
        "an", "cod_candidat", *as_double("medie_abs", "medie_adm"), "repartizat_id_liceu"
    )


# -- whole years --------------------------------------------------------------


@query("en_year", ov.sql(ov.INSTITUTIONS, ov.REGISTRY, ov.SOURCE_SCHOOLS, select=f"""
, keyed AS (SELECT DISTINCT cod_judet AS county, nume, {ov.match_key('nume', 'cod_judet')} AS key FROM source_schools),
own AS (SELECT *, alias = max(alias) OVER (PARTITION BY county, code) AS is_near FROM (
  SELECT DISTINCT cod_judet AS county, cod_siiir AS code, {ov.match_key('nume', 'cod_judet')} AS alias FROM institutions WHERE cod_siiir IS NOT NULL)),
exact AS (SELECT county, min(key) AS key, code FROM (
  SELECT county, key, max(code) AS code FROM keyed JOIN own USING (county) WHERE alias = key GROUP BY ALL) GROUP BY county, code)
SELECT county AS unitate_cod_judet, nume AS unitate_nume, code AS unitate_siiir FROM keyed LEFT JOIN exact USING (county, key)
"""))
def en_year(spark: SparkSession, sf: str) -> DataFrame:
    """8th-grade rows by school name, checked, and given codes in middle-school mode."""
    raw = views.source_schools(spark, sf).select(
        F.concat("cod_judet", F.abs(F.xxhash64("nume")).cast("string")).alias("cod"), F.col("nume").alias("scoala")
    )
    layer = loads.Layer(raw, {"cod_candidat": "cod", "unitate_nume": "scoala", "unitate_cod_judet": "cod"}, detect_origin=True)
    schools = loads.Schools(views.institutions(spark, sf))
    batch = loads.en_batch(layer, 1997, schools)
    return batch.select("unitate_cod_judet", "unitate_nume", "unitate_siiir")


_LATE = "late AS (SELECT DISTINCT l_orderkey AS ord FROM lineitem WHERE l_quantity = 50)"


@query("bac_year_load", ov.sql(ov.RESULTS, ov.MARKS, ex._REJECT_RAW, _LATE, select=f"""
SELECT an, regexp_extract(cod_candidat, '([0-9]+)', 1) AS cod_candidat, {ov.SEX} AS sex, {ov.EARLIER} AS promotie_anterioara,
  CASE WHEN late.ord IS NULL THEN {ov.fixed_code('unitate_siiir')} END AS unitate_siiir, lang AS limba_materna, lr AS lr_final,
  lm_f AS lm_final, dob AS do_final, da AS da_final, CASE WHEN ord % 50 = 7 THEN 5.55 ELSE medie END AS medie, {ov.RESULT_LABEL} AS rezultat
FROM means JOIN checked USING (ord) LEFT JOIN late USING (ord) WHERE len(why) = 0"""))
def bac_year_load(spark: SparkSession, sf: str) -> DataFrame:
    """All leaving-exam years loaded and read back: bad rows set aside, repeated candidates dropped,
    then the corrections."""
    records = ex.bac_records(spark, sf)
    again = records.filter(F.col("ord") % 3 == 0).withColumns({"sex": F.when(F.col("sex") == "x", "x").otherwise("f"), "seq": F.lit(2)})
    raw = records.withColumn("seq", F.lit(1)).unionByName(again)
    listed = views.table(spark, sf, "lineitem").filter("l_quantity = 50").select(F.col("l_orderkey").alias("ord"))
    late = records.join(listed, "ord").select(F.col("year").alias("an"), F.regexp_extract("cod_candidat", "([0-9]+)", 1).alias("cod_candidat"))
    table = YearTable(spark, shared_folder(spark, "bac"))
    layer = loads.Layer(raw, ex.BAC_MAPPING, keep_first_by=["seq"])
    years.load_bac_years(table, [layer], "year", corrections=late, strict=False)
    return table.read().select(
        "an", "cod_candidat", "sex", "promotie_anterioara", "unitate_siiir", "limba_materna",
        *as_double("lr_final", "lm_final", "do_final", "da_final", "medie"), "rezultat",
    )


@query("old_en_first_load", ov.sql(ov.RESULTS, ov.MARKS, _OLD_EN, select="""
, first AS (SELECT id_scoala AS id, arg_min(nume_scoala, ord) AS nume, min((ord, cod_siiir))[2] AS cod_siiir FROM old_en
  GROUP BY id_scoala)
SELECT id, nume, cod_siiir, n FROM first JOIN (SELECT id_scoala AS id, count(*) AS n FROM old_en GROUP BY ALL) USING (id)"""))
def old_en_first_load(spark: SparkSession, sf: str) -> DataFrame:
    """The first load of all years: its rows replace those stored (half of them), and the dimension grows from
    nothing by their schools. Schools with the number of their rows afterwards."""
    rows_of = rows.old_en_rows(old_en_records(spark, sf), F.col("an"), keep=["ord"])
    base = rows_of.filter(F.col("ord") % 2 == 0).drop("nume_scoala", "cod_siiir", "ord")
    batch = rows_of
    nothing = batch.filter(F.lit(False)).select(F.col("id_scoala").alias("id"), F.col("nume_scoala").alias("nume"), "cod_siiir")
    facts, grown = loads.old_en_year(base, batch, nothing, ["ord"], update=False)
    return grown.join(facts.groupBy(F.col("id_scoala").alias("id")).agg(F.count("*").alias("n")), "id").select("id", "nume", "cod_siiir", "n")


@query("change_stamp", ov.sql(_GROWN, select="""
SELECT coalesce(d.id, b.id) AS id, d.id IS NULL AS stamped FROM dim d FULL JOIN batch b ON b.id = d.id"""))
def change_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Schools added to the dimension carry the time of the change, within the last hour; old ones none."""
    old = _dimension(spark, sf).withColumn("last_updated", F.lit(None).cast("bigint"))
    new = dimension.grow_dimension(old.drop("last_updated"), _batch_schools(spark, sf), ["o_orderkey"], insert_only=True)
    stamped = new.join(old.select("id", F.lit(True).alias("_old")), "id", "left").withColumn(
        "last_updated", F.when(F.col("_old").isNull(), registry_cells.change_stamp())
    )
    age = F.unix_millis(F.current_timestamp()) - F.col("last_updated")
    return stamped.select("id", F.coalesce(age.between(0, 3_600_000), F.lit(False)).alias("stamped"))
