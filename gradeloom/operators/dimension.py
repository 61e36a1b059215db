"""Keeping the school dimension in step with facts and registry."""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions import names, registry as cells, rules
from gradeloom.operators.dedupe import keep_first, keep_last
from gradeloom.session import cut_lineage


class AliasCycleError(ValueError):
    """Aliases that lead back to themselves."""


def _filled(c: str):
    return F.nullif(F.col(c), F.lit(""))


def two_registry_lookup(facts: DataFrame, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """School name and county by the first registry's code, else by the second's.

    Codes are compared as numbers, so leading zeros do not count. ``code_known`` tells
    whether either registry had the code.
    """

    def by_number(table: DataFrame, code: str, mark: str) -> DataFrame:
        keyed = table.select(
            F.col(code).try_cast("bigint").alias(mark + "_code"),
            F.col("nume_unitate").alias(mark + "_name"),
            F.col("judet").alias(mark + "_county"),
            "nr_crt",
        ).filter(F.col(mark + "_code").isNotNull())
        last = keep_last(keyed, [mark + "_code"], ["nr_crt"]).drop("nr_crt")
        return last.withColumn(mark + "_county", names.county_from_text(mark + "_county"))

    first = by_number(primary, "cod_siiir", "_1")
    second = by_number(secondary, "cod_sirues", "_2")
    in_first, in_second = F.col("_1_code").isNotNull(), F.col("_2_code").isNotNull()
    return (
        facts.join(first, facts["siiir"].try_cast("bigint") == F.col("_1_code"), "left")
        .join(second, facts["sirues"].try_cast("bigint") == F.col("_2_code"), "left")
        .withColumns({
            "liceu": F.when(in_first, F.col("_1_name")).otherwise(F.col("_2_name")),
            "judet": F.when(in_first, F.col("_1_county")).otherwise(F.col("_2_county")),
            "code_known": in_first | in_second,
        })
        .drop("_1_code", "_1_name", "_1_county", "_2_code", "_2_name", "_2_county")
    )


def school_names(facts: DataFrame) -> DataFrame:
    """One name and county per school code: the most frequent; ``variants`` counts the others too.

    Rows are counted per spelling first, so a school with very many rows is reduced early.
    """
    spellings = (
        facts.select("unitate_siiir", "unitate_nume", "unitate_cod_judet").dropna()
        .groupBy("unitate_siiir", "unitate_nume", "unitate_cod_judet").agg(F.count("*").alias("n"))
    )
    spelling = F.struct("unitate_nume", "unitate_cod_judet")
    picked = spellings.groupBy(F.col("unitate_siiir").alias("cod_siiir")).agg(
        F.max_by(spelling, F.struct("n", "unitate_nume", "unitate_cod_judet")).alias("s"),
        F.count("*").alias("variants"),
    )
    return picked.select(
        "cod_siiir", F.col("s.unitate_nume").alias("nume"), F.col("s.unitate_cod_judet").alias("cod_judet"), "variants"
    )


def missing_schools(facts: DataFrame, institutions: DataFrame) -> DataFrame:
    """Schools with results but no dimension row, one per code, with a display name."""
    known = institutions.select("cod_siiir").dropna()
    missing = school_names(facts).join(known, "cod_siiir", "left_anti")
    return missing.withColumn("nume_afisat", names.display_name("nume"))


def unused_schools(institutions: DataFrame, codes: DataFrame) -> DataFrame:
    """Institutions with ``used``: false when the code occurs in no result.

    Rows without a code are kept (``used`` is null): nothing can be said about them.
    """
    used = codes.select(F.col("unitate_siiir").alias("cod_siiir"), F.lit(True).alias("_seen"))
    flag = F.when(F.col("cod_siiir").isNotNull(), F.col("_seen").isNotNull())
    return institutions.join(used, "cod_siiir", "left").withColumn("used", flag).drop("_seen")


def drop_unused_schools(institutions: DataFrame, codes: DataFrame) -> DataFrame:
    flagged = unused_schools(institutions, codes)
    return flagged.filter(F.coalesce("used", F.lit(True))).drop("used")


def name_drift(institutions: DataFrame, registry: DataFrame) -> DataFrame:
    """Institutions against the registry by code: missing, same or different name.

    The county is part of the comparison. Nothing is changed; ``nume_nou`` is the proposal.
    """
    official = keep_last(
        registry.select(
            F.col("cod_siiir_unitate").alias("cod_siiir"),
            F.col("denumire_lunga_unitate").alias("nume_registru"),
            F.col("judet_pj").alias("judet_registru"),
        ).dropna(subset=["cod_siiir"]),
        ["cod_siiir"], ["nume_registru", "judet_registru"],
    ).withColumns({
        "_found": F.lit(True),
        "_theirs": names.fold_key("nume_registru", "judet_registru"),
        "_proposal": names.display_name("nume_registru"),
    })
    same = names.fold_key("nume", "cod_judet").eqNullSafe(F.col("_theirs"))
    status = F.when(F.col("_found").isNull(), "missing").when(same, "same").otherwise("different")
    joined = institutions.join(official, "cod_siiir", "left").withColumn("status", status)
    new_name = F.when(F.col("status") == "different", F.col("_proposal"))
    return joined.withColumn("nume_nou", new_name).drop("_found", "_theirs", "_proposal")


def apply_name_drift(institutions: DataFrame, facts: DataFrame, proposals: DataFrame | None = None) -> DataFrame:
    """Institutions renamed after the results where the two names differ.

    ``proposals`` may supply names ``(nume, propus)``; a proposal counts only if it is the
    same name, else the rule-based display name is used. ``renamed`` marks changed rows.
    """
    current = school_names(facts).select(
        "cod_siiir", F.col("nume").alias("_name"), F.col("cod_judet").alias("_county")
    )
    if proposals is not None:
        one_each = proposals.groupBy(F.col("nume").alias("_name")).agg(F.max("propus").alias("_proposed"))
        current = current.join(one_each, "_name", "left")
    else:
        current = current.withColumn("_proposed", F.lit(None).cast("string"))
    current = current.withColumns({
        "_fold": names.fold_key("_name", "_county"),
        "_display": names.display_name_with_proposal("_name", "_proposed"),
    })
    differs = F.col("_name").isNotNull() & ~names.fold_key("nume", "cod_judet").eqNullSafe(F.col("_fold"))
    return (
        institutions.join(current, "cod_siiir", "left")
        .withColumn("renamed", differs)
        .withColumn("nume", F.when(F.col("renamed"), F.col("_display")).otherwise(F.col("nume")))
        .drop("_name", "_county", "_proposed", "_fold", "_display")
    )


def correct_assignments(facts: DataFrame, corrections: DataFrame) -> DataFrame:
    """Blank the school of listed candidates. ``corrections`` holds ``an, cod_candidat``."""
    listed = corrections.select("an", "cod_candidat").distinct().withColumn("_hit", F.lit(True))
    school = ["unitate_siiir", "unitate_cod_judet", "unitate_nume"]
    blanked = {c: F.when(F.col("_hit").isNull(), F.col(c)) for c in school}
    return facts.join(listed, ["an", "cod_candidat"], "left").withColumns(blanked).drop("_hit").select(*facts.columns)


def correction_counts(facts: DataFrame, corrections: DataFrame) -> DataFrame:
    """Rows that each correction touches, zero included."""
    listed = corrections.select("an", "cod_candidat").distinct()
    hits = facts.join(listed, ["an", "cod_candidat"], "left_semi").groupBy("an", "cod_candidat")
    return listed.join(hits.agg(F.count("*").alias("rows")), ["an", "cod_candidat"], "left").fillna(0, ["rows"])


def resolve_aliases(alias: DataFrame) -> DataFrame:
    """Aliases ``(alternativ, corect)`` with chains followed to their end; a cycle is an error.

    Each round doubles the distance followed, so a chain of n aliases takes log2(n) rounds.
    """
    links = alias.filter("alternativ <> corect").groupBy("alternativ").agg(F.min("corect").alias("corect"))
    links = cut_lineage(links)
    rounds = ceil(log2(links.count() + 1)) + 1
    for _ in range(rounds):
        ends = links.select(F.col("alternativ").alias("corect"), F.col("corect").alias("_next"))
        if links.join(ends, "corect", "left_semi").isEmpty():
            return links
        step = links.join(ends, "corect", "left")
        links = cut_lineage(step.select("alternativ", F.coalesce("_next", "corect").alias("corect")))
    raise AliasCycleError("aliases form a cycle")


def remap_ids(facts: DataFrame, resolved: DataFrame, column: str) -> DataFrame:
    """Alias ids of one column replaced by the right ones."""
    target = resolved.select(F.col("alternativ").alias(column), "corect")
    mapped = facts.join(target, column, "left").withColumn(column, F.coalesce("corect", column))
    return mapped.select(*facts.columns)


def drop_alias_rows(institutions: DataFrame, alias: DataFrame) -> DataFrame:
    return institutions.join(alias.select(F.col("alternativ").alias("id")), "id", "left_anti")


def unify_dimensions(high: DataFrame, middle: DataFrame) -> DataFrame:
    """All high schools, and the middle schools whose id is not among them."""
    only_middle = middle.join(high.select("id"), "id", "left_anti").select("id", "nume")
    return high.unionByName(only_middle, allowMissingColumns=True)


def codes_by_id(institutions: DataFrame, registry: DataFrame) -> DataFrame:
    """School codes found through the canonical id of the registry name (older rule)."""
    county = names.county_from_text("judet")
    found = (
        registry.filter(F.col("tip_unitate") == rules.REGISTRY_SCHOOL_TYPE)
        .select(names.canonical_id("denumire", county, place_rules=False).alias("id"), "cod")
        .groupBy("id").agg(F.max("cod").alias("_cod"))
    )
    code = F.coalesce("_cod", "cod_siiir")
    return institutions.join(found, "id", "left").withColumn("cod_siiir", code).drop("_cod")


def backfill_attributes(institutions: DataFrame, registry: DataFrame) -> DataFrame:
    """Address and web site where empty; phone and tax code wherever the registry has them."""
    source = registry.select(
        F.col("cod").alias("cod_siiir"),
        F.lit(True).alias("_found"),
        cells.postal_address("strada", "nr_strada", "localitate", "cod_postal").alias("_adresa"),
        _filled("website").alias("_website"),
        _filled("telefon").alias("_telefon"),
        _filled("cod_fiscal").alias("_cod_fiscal"),
    ).dropna(subset=["cod_siiir"])
    source = keep_last(source, ["cod_siiir"], ["_adresa", "_website", "_telefon", "_cod_fiscal"])
    joined = institutions.join(source, "cod_siiir", "left")
    return joined.withColumns({
        "adresa": F.coalesce(_filled("adresa"), "_adresa", "adresa"),
        "website": F.coalesce(_filled("website"), "_website", "website"),
        "telefon": F.coalesce("_telefon", "telefon"),
        "cod_fiscal": F.coalesce("_cod_fiscal", "cod_fiscal"),
    }).drop("_found", "_adresa", "_website", "_telefon", "_cod_fiscal")


def membership_flags(institutions: DataFrame, middle: DataFrame, high: DataFrame) -> DataFrame:
    """Whether an institution occurs among the middle schools and among the high schools."""
    flagged = institutions
    for flag, members in (("gimnaziu", middle), ("liceu", high)):
        ids = members.select("id").dropna().distinct().withColumn("_in", F.lit(True))
        flagged = flagged.drop(flag).join(ids, "id", "left").withColumn(flag, F.col("_in").isNotNull()).drop("_in")
    return flagged


def files_of_schools(files: DataFrame, name: str = "file_name") -> DataFrame:
    """School ids that a file name ``id(_n)?.suffix`` can belong to."""
    stem = F.split_part(F.col(name), F.lit("."), F.lit(1))
    suffix = r"^[^.]+\.(" + "|".join(rules.IMAGE_SUFFIXES) + ")"
    ids = F.array_distinct(F.array(stem, F.regexp_replace(stem, "_[0-9]+$", "")))
    return files.filter(F.col(name).rlike(suffix)).select(name, F.explode(ids).alias("id"))


def attach_files(
    institutions: DataFrame, files: DataFrame, small_files: DataFrame | None = None, name: str = "file_name"
) -> DataFrame:
    """First file, by name, of each school; ``sigla_xs`` tells whether a small one exists."""
    first = files_of_schools(files, name).groupBy("id").agg(F.min(name).alias("_sigla"))
    result = institutions.join(first, "id", "left")
    old = F.col("sigla") if "sigla" in institutions.columns else F.lit(None).cast("string")
    result = result.withColumn("sigla", F.coalesce(F.col("_sigla"), old)).drop("_sigla")
    if small_files is not None:
        small = files_of_schools(small_files, name).select("id").distinct().withColumn("_xs", F.lit(True))
        result = result.drop("sigla_xs").join(small, "id", "left")
        result = result.withColumn("sigla_xs", F.col("_xs").isNotNull()).drop("_xs")
    return result


def schools_with_many_files(institutions: DataFrame, files: DataFrame, name: str = "file_name") -> DataFrame:
    """Schools that more than one file belongs to."""
    counted = files_of_schools(files, name).groupBy("id").agg(F.countDistinct(name).alias("n")).filter("n > 1")
    return counted.join(institutions.select("id").distinct(), "id", "left_semi")


def fill_display_names(schools: DataFrame, twins: DataFrame, proposals: DataFrame | None = None) -> DataFrame:
    """Display name kept, else the twin's by id, else a proposal for the id, else rule-based."""
    twin = twins.groupBy("id").agg(F.max("nume_afisat").alias("_twin"))
    filled = schools.join(twin, "id", "left")
    if proposals is not None:
        filled = filled.join(proposals.groupBy("id").agg(F.max("propus").alias("_proposed")), "id", "left")
    else:
        filled = filled.withColumn("_proposed", F.lit(None).cast("string"))
    made = names.display_name_with_proposal("nume", "_proposed")
    return filled.withColumn("nume_afisat", F.coalesce("nume_afisat", "_twin", made)).drop("_twin", "_proposed")


def grow_dimension(
    institutions: DataFrame, batch: DataFrame, order: list[str], insert_only: bool = False
) -> DataFrame:
    """Schools ``(id, nume, cod_siiir)`` of a batch merged into the dimension.

    The first row per id counts. Known schools take its name and code, unless ``insert_only``:
    then only new schools are added, as middle schools, with a display name and a change stamp.
    """
    schools = keep_first(batch.dropna(subset=["id"]), ["id"], order).select("id", "nume", "cod_siiir")
    new = schools.join(institutions.select("id"), "id", "left_anti")
    if insert_only:
        new = new.select(
            "id", names.display_name("nume").alias("nume"),
            F.lit(True).alias("gimnaziu"), cells.change_stamp().alias("last_updated"),
        )
        return institutions.unionByName(new, allowMissingColumns=True).select(*institutions.columns)
    fresh = schools.select(
        "id", F.col("nume").alias("_nume"), F.col("cod_siiir").alias("_cod"), F.lit(True).alias("_hit")
    )
    hit = F.col("_hit").isNotNull()
    known = institutions.join(fresh, "id", "left").withColumns({
        "nume": F.when(hit, F.col("_nume")).otherwise(F.col("nume")),
        "cod_siiir": F.when(hit, F.col("_cod")).otherwise(F.col("cod_siiir")),
    })
    return known.select(*institutions.columns).unionByName(new, allowMissingColumns=True)


def fill_coordinates(institutions: DataFrame, coordinates: DataFrame) -> DataFrame:
    """``long,lat`` text where it is still missing."""
    point = F.concat(F.col("long").cast("string"), F.lit(","), F.col("lat").cast("string"))
    points = coordinates.groupBy("id").agg(F.max(point).alias("_point"))
    filled = institutions.join(points, "id", "left")
    return filled.withColumn("longlat", F.coalesce("longlat", "_point")).drop("_point")
