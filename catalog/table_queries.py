"""Queries over duplicates, updates, rankings, pages and stored files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import expression_queries as ex
from catalog import oracle_views as ov
from catalog import views
from catalog.registry import query
from gradeloom.functions import grades
from gradeloom.functions import registry as cells
from gradeloom.operators import dedupe, pages, ranking, updates
from gradeloom.plans import loads
from gradeloom.session import shared_folder
from gradeloom.sources import readers, tables
from gradeloom.sources.years import YearTable

# -- duplicates and sets ------------------------------------------------------

_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_LINE_ORDER)


def _picked_line(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LINE_ORDER)
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1"""


@query("keep_first", _picked_line("ASC"))
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    first = dedupe.keep_first(_lines(spark, sf), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("keep_last", _picked_line("DESC"))
def keep_last(spark: SparkSession, sf: str) -> DataFrame:
    last = dedupe.keep_last(_lines(spark, sf), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return last.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.duplicate_keys(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n FROM lineitem JOIN (
  SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1)
USING (l_orderkey, l_linenumber)""")
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return dedupe.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query("distinct_schools", ov.sql(ov.RESULTS, select="SELECT DISTINCT unitate_nume, unitate_cod_judet FROM results"))
def distinct_schools(spark: SparkSession, sf: str) -> DataFrame:
    return dedupe.distinct_schools(views.candidates(spark, sf), "unitate_nume", "unitate_cod_judet")


@query("used_codes", ov.sql(ov.RESULTS, ov.INSTITUTIONS, select="""
SELECT unitate_siiir FROM results UNION SELECT cod_siiir FROM institutions"""))
def used_codes(spark: SparkSession, sf: str) -> DataFrame:
    other = views.institutions(spark, sf).withColumnRenamed("cod_siiir", "unitate_siiir")
    return dedupe.used_codes(views.candidates(spark, sf), other)


@query("school_triples", ov.sql(ov.RESULTS, select=f"""
SELECT DISTINCT unitate_siiir, unitate_nume, unitate_cod_judet FROM results WHERE NOT {ov.EARLIER} AND unitate_siiir IS NOT NULL"""))
def school_triples(spark: SparkSession, sf: str) -> DataFrame:
    own = F.col("promotie").eqNullSafe(F.concat((F.col("an") - 1).cast("string"), F.lit("-"), F.col("an").cast("string")))
    facts = views.candidates(spark, sf).withColumn("promotie_anterioara", ~own)
    return dedupe.school_triples(facts, own_cohort_only=True, drop_nulls=True)


# -- rankings -----------------------------------------------------------------

_AVERAGES = """
averages AS (SELECT an, unitate_nume || ', ' || unitate_cod_judet AS id, count(*) AS n,
  cast(sum(cast(round(medie * 100) AS bigint)) AS double) / (count(*) * 100) AS medie FROM means WHERE medie IS NOT NULL GROUP BY ALL),
en_averages AS (SELECT an, unitate_nume || ', ' || unitate_cod_judet AS id,
  cast(sum(cast(round(medie_en * 100) AS bigint)) AS double) / (count(*) * 100) AS medie FROM means WHERE medie_en IS NOT NULL GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY an ORDER BY medie DESC, id) AS rank FROM averages),
en_ranked AS (SELECT *, row_number() OVER (PARTITION BY an ORDER BY medie DESC, id) AS rank FROM en_averages)
"""


def averaged(spark: SparkSession, sf: str) -> DataFrame:
    school = F.concat("unitate_nume", F.lit(", "), "unitate_cod_judet")
    return ex._means(spark, sf).select("an", school.alias("school"), "medie", "medie_en")


@query("school_rank", ov.sql(ov.RESULTS, ov.MARKS, _AVERAGES, select="SELECT an, id, n, medie, rank FROM ranked"))
def school_rank(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.school_rank(averaged(spark, sf), "school", "medie")


@query("combined_rank", ov.sql(ov.RESULTS, ov.MARKS, _AVERAGES, select="""
SELECT id, coalesce(h.rank, m.rank, 1000000) AS rank
FROM (SELECT DISTINCT unitate_nume || ', ' || unitate_cod_judet AS id FROM results) i
LEFT JOIN (SELECT * FROM ranked WHERE an = 1997) h USING (id) LEFT JOIN (SELECT * FROM en_ranked WHERE an = 1997) m USING (id)"""))
def combined_rank(spark: SparkSession, sf: str) -> DataFrame:
    facts = averaged(spark, sf)
    middle = ranking.school_rank(facts, "school", "medie_en", 1997)
    high = ranking.school_rank(facts, "school", "medie", 1997)
    school = F.concat("unitate_nume", F.lit(", "), "unitate_cod_judet")
    schools = views.candidates(spark, sf).select(school.alias("id")).distinct()
    return ranking.combined_rank(schools, middle, high)


@query("website_work_list", ov.sql(ov.LISTED, select="SELECT id, website, id % 100 AS rank FROM listed WHERE website IS NOT NULL"))
def website_work_list(spark: SparkSession, sf: str) -> DataFrame:
    listed = views.listed_schools(spark, sf).withColumn("rank", F.col("id") % 100)
    return ranking.website_work_list(listed).select("id", "website", "rank")


@query("run_metrics", ov.sql(ov.RESULTS, select="""
SELECT count(*) AS "rows", count(unitate_siiir) AS with_code, count(*) - count(unitate_siiir) AS without_code,
  count(*) FILTER (rezultat = 'REUSIT') AS matched FROM results"""))
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    facts = views.candidates(spark, sf).withColumn("matched", F.col("rezultat") == "REUSIT")
    return updates.run_metrics(facts, "matched", "unitate_siiir")


# -- updates ------------------------------------------------------------------

_BASE = "base AS (SELECT cast(year(o_orderdate) AS int) AS an, o_orderkey AS cod, o_orderstatus AS status, o_totalprice AS price, o_orderpriority AS note FROM orders)"
_BATCH = """
batch AS (SELECT cod, status, price, note FROM (
  SELECT l_orderkey + 100 AS cod, CASE WHEN l_quantity > 25 THEN l_linestatus END AS status, l_extendedprice AS price,
    cast(NULL AS varchar) AS note, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
  FROM lineitem) WHERE rn = 1)
"""
_BATCH_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def stored_rows(spark: SparkSession, sf: str) -> DataFrame:
    return views.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("an"), F.col("o_orderkey").alias("cod"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("note"),
    )


def update_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as updates of orders: several per key, some keys unknown, one column all null."""
    return views.table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") + 100).alias("cod"),
        F.when(F.col("l_quantity") > 25, F.col("l_linestatus")).alias("status"),
        F.col("l_extendedprice").alias("price"),
        F.lit(None).cast("string").alias("note"),
        *_BATCH_ORDER,
    )


def _first_updates(spark: SparkSession, sf: str) -> DataFrame:
    first = dedupe.keep_first(update_batch(spark, sf), ["cod"], _BATCH_ORDER)
    return first.select("cod", "status", "price", "note")


@query("update_by_key", ov.sql(_BASE, _BATCH, select="""
SELECT base.an, base.cod, CASE WHEN batch.cod IS NULL THEN base.status ELSE batch.status END AS status,
  CASE WHEN batch.cod IS NULL THEN base.price ELSE batch.price END AS price, base.note
FROM base LEFT JOIN batch ON base.cod = batch.cod"""))
def update_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return updates.update_by_key(stored_rows(spark, sf), update_batch(spark, sf), ["cod"], order=_BATCH_ORDER)


@query("update_cells", ov.sql(_BASE, _BATCH, select="""
SELECT base.an, base.cod, coalesce(batch.status, base.status) AS status, coalesce(batch.price, base.price) AS price, base.note
FROM base LEFT JOIN batch ON base.cod = batch.cod"""))
def update_cells(spark: SparkSession, sf: str) -> DataFrame:
    return updates.update_by_key(
        stored_rows(spark, sf), update_batch(spark, sf), ["cod"], mode="cell", order=_BATCH_ORDER
    )


@query("upsert_by_key", ov.sql(_BASE, _BATCH, select="""
SELECT base.an, coalesce(base.cod, batch.cod) AS cod, coalesce(base.status, CASE WHEN base.cod IS NULL THEN batch.status END) AS status,
  coalesce(batch.price, base.price) AS price, base.note, base.cod IS NULL AS is_new
FROM base FULL JOIN batch ON base.cod = batch.cod"""))
def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return updates.upsert_by_key(stored_rows(spark, sf), _first_updates(spark, sf), ["cod"], ["price"])


@query("unknown_keys", ov.sql(_BASE, _BATCH, select="SELECT cod, price FROM batch WHERE cod NOT IN (SELECT cod FROM base)"))
def unknown_keys(spark: SparkSession, sf: str) -> DataFrame:
    return updates.unknown_keys(stored_rows(spark, sf), _first_updates(spark, sf), ["cod"]).select("cod", "price")


@query("bad_values", ov.sql(ov.RESULTS, ov.MARKS, select="SELECT an, cod_candidat FROM marks WHERE lr_i IS NULL"))
def bad_values(spark: SparkSession, sf: str) -> DataFrame:
    parsed = views.results(spark, sf).withColumn("grade", grades.parse_grade("lr_init"))
    return updates.bad_values(parsed, ["an", "cod_candidat"], "grade")


@query("active_columns", """
SELECT name, active FROM (SELECT 'status' AS name, count(CASE WHEN l_quantity > 25 THEN l_linestatus END) > 0 AS active FROM lineitem
UNION ALL SELECT 'price', count(l_extendedprice) > 0 FROM lineitem UNION ALL SELECT 'note', false)""")
def active_columns(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["status", "price", "note"]
    found = updates.active_columns(update_batch(spark, sf), columns)
    return spark.createDataFrame([(c, c in found) for c in columns], "name string, active boolean")


@query("replace_year", ov.sql(_BASE, select="""
SELECT an, cod, CASE WHEN an = 1997 THEN 'new' ELSE status END AS status, price FROM base WHERE NOT (an = 1997 AND status = 'P')"""))
def replace_year(spark: SparkSession, sf: str) -> DataFrame:
    """All years stored, then one year replaced by changed and fewer rows."""
    stored, table = stored_rows(spark, sf).drop("note"), YearTable(spark, shared_folder(spark, "years"))
    table.replace(stored, [r[0] for r in stored.select("an").distinct().collect()])
    fresh = table.read(years=[1997]).filter("status <> 'P'")
    table.replace(fresh.withColumn("status", F.lit("new")), [1997])
    return table.read().select("an", "cod", "status", "price")


@query("replaced_table", """
SELECT c_custkey AS id, 'new ' || c_name AS name FROM customer WHERE c_custkey % 3 <> 0""")
def replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table stored, then replaced as a whole by rows made from itself."""
    path = shared_folder(spark, "table")
    tables.replace_table(views.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    stored = tables.current_table(spark, path)
    changed = F.concat(F.lit("new "), "name")
    tables.replace_table(stored.filter(F.col("id") % 3 != 0).withColumn("name", changed), path)
    return tables.current_table(spark, path)


@query("layered_year", ov.sql(_BASE, _BATCH, select="""
SELECT base.an, base.cod, CASE WHEN batch.cod IS NULL THEN base.status ELSE batch.status END AS status,
  CASE WHEN batch.cod IS NULL THEN base.price ELSE batch.price END AS price, base.note
FROM base LEFT JOIN batch ON base.cod = batch.cod AND base.an = 1996"""))
def layered_year(spark: SparkSession, sf: str) -> DataFrame:
    """All years stored; one of them updated from a second source and written back."""
    path = shared_folder(spark, "layers")
    stored_rows(spark, sf).withColumnRenamed("cod", "cod_candidat").write.partitionBy("an").parquet(path)
    batch = update_batch(spark, sf).withColumnRenamed("cod", "cod_candidat").withColumn("an", F.lit(1996))
    loads.apply_batch(spark, batch, path, 1996, update=True, order=_BATCH_ORDER)
    return spark.read.parquet(path).select("an", F.col("cod_candidat").alias("cod"), "status", "price", "note")


# -- files --------------------------------------------------------------------


@query("csv_records", """
SELECT set_no, page_no, row_no, crt, txt FROM (
  SELECT cast(o_orderkey // 5000 AS string) AS set_no, cast((o_orderkey % 5000) // 20 + 1 AS string) AS page_no,
    cast(o_orderkey % 20 AS string) AS row_no, cast(o_orderkey % 5000 + 1 AS string) AS crt,
    'a "' || o_orderpriority || '", ' || chr(10) || 'b' AS txt FROM orders)""")
def csv_records(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written as headed CSV in page order, with quotes and line breaks, and read back."""
    path = shared_folder(spark, "csv")
    text = F.concat(F.lit('a "'), "value", F.lit('", \nb'))
    ordered = views.numbered_rows(spark, sf).withColumn("txt", text).drop("value")
    tables.write_csv(ordered, path, ["set_no", "page_no", "row_no"], drop_order=False)
    return readers.read_records(spark, path).drop(readers.BAD_LINE)


@query("json_records", """
SELECT cast(c_custkey AS string) AS id, cast(c_nationkey AS string) AS nation, c_mktsegment AS segment FROM customer""")
def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written as JSON and read back as strings."""
    path = shared_folder(spark, "json")
    rows = views.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    tables.write_json(rows, path)
    return readers.read_records(spark, path, "json", lines=True)


@query("merged_records", """
SELECT cast(c_custkey AS string) AS id, c_name AS name, c_mktsegment AS segment, cast(NULL AS varchar) AS balance, 'a' AS source FROM customer
UNION ALL SELECT cast(s_suppkey AS string), s_name, NULL, cast(cast(floor(s_acctbal) AS bigint) AS string), 'b' FROM supplier""")
def merged_records(spark: SparkSession, sf: str) -> DataFrame:
    """Two sets of files with different headers, read as one, with the file each row came from."""
    path = shared_folder(spark, "sets")
    customer, supplier = views.table(spark, sf, "customer"), views.table(spark, sf, "supplier")
    one = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    two = supplier.select(
        F.floor("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
    )
    one.write.csv(f"{path}/a", header=True)
    two.write.csv(f"{path}/b", header=True)
    merged = readers.read_many(spark, [f"{path}/a", f"{path}/b"]).drop(readers.BAD_LINE)
    return merged.withColumn("source", F.element_at(F.split("source_file", "/"), -2)).drop("source_file")


@query("typed_csv", """
SELECT o_orderkey::double AS nr, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price, nullif(trim(CASE WHEN o_orderkey % 7 = 0 THEN '  '
  ELSE ' ' || o_orderpriority || ' ' END), '') AS name FROM orders""")
def typed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Headerless CSV read by a typed layout: numbers or null, trimmed text or null."""
    path, key = shared_folder(spark, "typed"), F.col("o_orderkey")
    price = F.when(key % 5 != 0, F.col("o_totalprice").cast("string")).otherwise("n/a")
    name = F.when(key % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")))
    views.table(spark, sf, "orders").select(key, price, name).write.options(
        quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return readers.read_typed_csv(spark, path, ["nr,num", "price,num", "name,str"]).drop(readers.BAD_LINE)


@query("bad_lines", """
SELECT o_orderkey::double AS nr, CASE WHEN o_orderkey % 10 <> 1 THEN o_orderpriority END AS name,
  o_orderkey % 10 IN (0, 1) AS bad FROM orders""")
def bad_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a cell too many or too few are told from good ones."""
    path, key = shared_folder(spark, "lines"), F.col("o_orderkey")
    rest = F.when(key % 10 == 1, "").otherwise(F.concat(F.lit(","), "o_orderpriority", F.when(key % 10 == 0, ",more").otherwise("")))
    views.table(spark, sf, "orders").select(F.concat(key.cast("string"), rest)).write.text(path)
    read = readers.read_typed_csv(spark, path, ["nr,num", "name,str"])
    return read.select("nr", "name", F.col(readers.BAD_LINE).isNotNull().alias("bad"))


@query("header_promotion", """
SELECT cast(p_partkey AS string) AS "Nr.", p_name AS "Denumire Unitate", p_brand AS "Cod SIIIR" FROM part""")
def header_promotion(spark: SparkSession, sf: str) -> DataFrame:
    return readers.promote_header(part_grid(spark, sf), "row", 2).drop("row")


def part_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as a grid of cells under a title row, an empty row and a header row."""
    top = spark.createDataFrame(
        [(-3, "Titlu", None, None), (-2, None, None, None), (-1, "Nr.", "Denumire Unitate", "Cod SIIIR")],
        "row bigint, c0 string, c1 string, c2 string",
    )
    body = views.table(spark, sf, "part").select(
        F.col("p_partkey").alias("row"), F.col("p_partkey").cast("string").alias("c0"),
        F.col("p_name").alias("c1"), F.col("p_brand").alias("c2"),
    )
    return top.unionByName(body)


@query("registry_rows", """
SELECT nr, denumire_unitate, cod_siiir, why FROM (SELECT cast(p_partkey AS string) AS nr, p_name AS denumire_unitate,
  cast(NULL AS varchar) AS cod_siiir, 'Cod SIIIR' AS why FROM part)""")
def registry_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Registry grid cleaned; brands are no school codes, so every row names that reason."""
    rows = loads.registry_rows(part_grid(spark, sf), "row")
    return rows.select("nr", "denumire_unitate", "cod_siiir", F.array_join("reject_reasons", ",").alias("why"))


@query("registry_json", """
SELECT cast(s_suppkey AS string) AS cod, cast(s_suppkey + 1 AS string) AS aux_id, s_name AS denumire, n_name AS judet
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def registry_json(spark: SparkSession, sf: str) -> DataFrame:
    """Nested registry responses, one per nation and hundred suppliers, flattened."""
    supplier, nation = views.table(spark, sf, "supplier"), views.table(spark, sf, "nation")
    school = F.struct(
        F.col("s_suppkey").alias("CODE"), (F.col("s_suppkey") + 1).alias("ID_SCHOOL"),
        F.col("s_name").alias("NAME"), F.col("n_name").alias("COUNTY"),
    )
    pages_of = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).groupBy(
        "n_name", F.floor(F.col("s_suppkey") / 100).alias("page")
    )
    responses = pages_of.agg(F.struct(F.collect_list(school).alias("content")).alias("data"))
    return readers.registry_from_json(responses).select("cod", "aux_id", "denumire", "judet")


@query("registry_details", ov.sql(ov.DETAILS, select="""
SELECT s_suppkey AS aux_id, s_name AS denumire, CASE WHEN s_suppkey % 8 = 0 THEN 'veche' ELSE d.strada END AS strada,
  CASE WHEN s_suppkey % 8 = 0 THEN 'vechi' ELSE d.website END AS website,
  CASE WHEN s_suppkey % 8 = 0 THEN '1' ELSE d.telefon END AS telefon
FROM supplier JOIN details d ON s_suppkey = aux_id"""))
def registry_details(spark: SparkSession, sf: str) -> DataFrame:
    """Detail records over registry rows; a record also replaces values by null."""
    registry = views.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("aux_id"), F.col("s_name").alias("denumire"), F.lit("veche").alias("strada"),
        F.lit("vechi").alias("website"), F.lit("1").alias("telefon"),
    )
    latest = views.school_details(spark, sf).filter(F.col("aux_id") % 8 != 0)
    field = {"street": "strada", "streetNumber": "nr_strada", "postalCode": "cod_postal", "website": "website",
             "phoneNumber": "telefon", "fiscalCode": "cod_fiscal"}
    records = latest.select(
        "aux_id", *[F.col(c).alias(f) for f, c in field.items()], F.lit(None).alias("siruesCode"),
        F.lit(None).alias("operatingMode"), F.lit(2).alias("seen"),
    )
    older = records.withColumns({"street": F.lit("old"), "seen": F.lit(1)})
    return updates.apply_details(registry, older.unionByName(records), ["seen"]).select(
        "aux_id", "denumire", "strada", "website", "telefon"
    )


# -- pages --------------------------------------------------------------------


@query("page_rows", """
SELECT page_id, (unnest(range(len(items))))::int AS row_no, unnest(items) AS txt FROM (
  SELECT page_id, list_transform(regexp_extract_all(html, '(?s)<li\\b[^>]*>(.*?)</li>', 1), lambda r:
    array_to_string(list_transform(regexp_extract_all(r, '(?s)<a\\b[^>]*>(.*?)</a>', 1), lambda c:
      trim(replace(replace(replace(c, '&lt;', '<'), '&gt;', '>'), '&amp;', '&'))), '|')) AS items
  FROM pages WHERE NOT contains(html, 'Eroare'))""")
def page_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.page_rows(views.table(spark, sf, "pages"), pages.LIST_ROW, pages.LINK_CELL)
    return rows.select("page_id", F.col("row_no").cast("int").alias("row_no"), F.array_join("cells", "|").alias("txt"))


@query("result_page_rows", ov.sql(ov.NUMBERED, select="""
SELECT set_no, page_no, (row_number() OVER (PARTITION BY set_no, page_no ORDER BY row_no) - 1)::int AS row_no,
  crt || '|Nota<br/>' || value || '<br/>& ășî &lt; x|' || cast(row_no % 3 AS string) AS txt
FROM numbered WHERE page_no % 101 <> 0"""))
def result_page_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = pages.page_rows(
        views.result_pages(spark, sf), separator="<br/>", two_lines=True, keep=["set_no", "page_no"]
    )
    return rows.select("set_no", "page_no", F.col("row_no").cast("int").alias("row_no"), F.array_join("cells", "|").alias("txt"))


@query("two_line_records", """
SELECT o_orderkey AS id, array_to_string(list_transform(range(2) || range(2 + p, 12 + p) || range(100, 104) || range(12 + p, 15 + p)
    || range(104, 107) || [15 + p] || range(107, 110) || range(16 + p, 19 + p), lambda i:
      'c' || cast(i AS string) || '-' || o_orderstatus
      || CASE WHEN i IN (0, 2 + p, 100, 12 + p, 104, 15 + p, 107, 16 + p) THEN chr(10) || 'more' ELSE '' END), '|') AS txt
FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 2 END AS p FROM orders)""")
def two_line_records(spark: SparkSession, sf: str) -> DataFrame:
    """Older two-line records: the first line has 19 or 21 cells, the second ten."""
    def cells_from(start: int, count) -> F.Column:
        numbers = F.sequence(F.lit(start), F.lit(start) + count - 1)
        return F.transform(numbers, lambda i: F.concat(F.lit(" c"), i.cast("string"), F.lit("-"), "o_orderstatus", F.lit("\nmore")))

    first = cells_from(0, F.when(F.col("o_orderkey") % 2 == 0, 19).otherwise(21))
    record = pages.reorder_two_lines(first, cells_from(100, F.lit(10)))
    return views.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(record, "|").alias("txt"))


@query("page_counts", ov.sql(ov.NUMBERED, select="""
SELECT DISTINCT set_no, page_no, 250 AS highest, page_no AS last FROM numbered"""))
def page_counts(spark: SparkSession, sf: str) -> DataFrame:
    return views.result_pages(spark, sf).select(
        "set_no", "page_no", pages.page_count("html").alias("highest"), pages.page_count("html", last=True).alias("last")
    )


@query("form_fields", ov.sql(ov.NUMBERED, select="""
SELECT DISTINCT set_no, page_no, 'v' || cast(page_no AS string) AS viewstate, page_no % 3 <> 0 AS complete,
  CASE WHEN page_no % 3 <> 0 THEN 3 ELSE 2 END AS fields FROM numbered"""))
def form_fields(spark: SparkSession, sf: str) -> DataFrame:
    fields = pages.hidden_fields("html")
    return views.result_pages(spark, sf).select(
        "set_no", "page_no", fields["__VIEWSTATE"].alias("viewstate"), pages.has_form_fields("html").alias("complete"),
        F.size(fields).alias("fields"),
    )


@query("page_audit", ov.sql(ov.NUMBERED, ov.FOUND, select="""
SELECT set_no, page_no, "rows", first_no, last_no, (page_no - 1) * 20 + 1 AS expected_first,
  cast(first_no AS bigint) <> (page_no - 1) * 20 + 1 AS wrong_first, "rows" <> 20 AND page_no < last_no AS wrong_size,
  cast(first_no AS bigint) <> (page_no - 1) * 20 + 1 OR ("rows" <> 20 AND page_no < last_no) AS refetch
FROM (SELECT set_no, page_no, count(*) AS "rows", arg_min(crt, row_no) AS first_no, max(page_no) OVER (PARTITION BY set_no) AS last_no
  FROM found_rows GROUP BY set_no, page_no)"""))
def page_audit(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_audit(views.found_rows(spark, sf), ["set_no", "page_no"], "crt", 20, set_key=["set_no"])


def _page_counts_per_set(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.numbered_rows(spark, sf)
    return rows.groupBy("set_no").agg((F.max("page_no") + 3).cast("int").alias("pages"))


@query("expected_pages", ov.sql(ov.NUMBERED, select="""
SELECT set_no, page_no::int AS page_no, (page_no // 10)::int AS batch FROM (
  SELECT set_no, unnest(range(1, max(page_no) + 4)) AS page_no FROM numbered GROUP BY set_no)"""))
def expected_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.expected_pages(_page_counts_per_set(spark, sf), "set_no", "pages")


@query("missing_pages", ov.sql(ov.NUMBERED, ov.FOUND, select="""
SELECT set_no, page_no::int AS page_no, (page_no // 10)::int AS batch FROM (
  SELECT set_no, unnest(range(1, max(page_no) + 4)) AS page_no FROM numbered GROUP BY set_no) e
WHERE NOT EXISTS (SELECT 1 FROM found_rows n WHERE n.set_no = e.set_no AND n.page_no = e.page_no)"""))
def missing_pages(spark: SparkSession, sf: str) -> DataFrame:
    expected = pages.expected_pages(_page_counts_per_set(spark, sf), "set_no", "pages")
    return pages.missing_pages(expected, views.found_rows(spark, sf), ["set_no", "page_no"])


@query("page_order", ov.sql(ov.NUMBERED, select="SELECT set_no, page_no, row_no, crt, value FROM numbered"))
def page_order(spark: SparkSession, sf: str) -> DataFrame:
    return pages.in_page_order(views.numbered_rows(spark, sf), ["set_no", "page_no", "row_no"])


@query("page_county", ov.sql(ov.COUNTIES, ov.NUMBERED, select="""
SELECT set_no, page_no, row_no, (row_no % 50)::int AS county_no, code AS cod_judet FROM numbered LEFT JOIN counties ON pos = row_no % 50"""))
def page_county(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.numbered_rows(spark, sf).withColumn("county_no", (F.col("row_no") % 50).cast("int"))
    return pages.with_county(rows, "county_no").select("set_no", "page_no", "row_no", "county_no", "cod_judet")


@query("postal_address", ov.sql(ov.DETAILS, select="""
SELECT aux_id, trim(strada, ' ,.') || CASE WHEN trim(nr_strada) IN ('', '-', '.', 'x') THEN '' ELSE ' ' || trim(nr_strada, ' ,.') END
  || coalesce(', ' || array_to_string(list_transform(regexp_extract_all(localitate, '\\p{L}+|[^\\p{L}]+'), lambda w:
       upper(substr(w, 1, 1)) || lower(substr(w, 2))), ''), '') || coalesce(', ' || cod_postal, '') AS adresa FROM details"""))
def postal_address(spark: SparkSession, sf: str) -> DataFrame:
    address = cells.postal_address("strada", "nr_strada", "localitate", "cod_postal")
    return views.school_details(spark, sf).select("aux_id", address.alias("adresa"))
