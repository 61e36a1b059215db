"""School names to school codes: exact, then by edit distance inside a county.

Keys come from :func:`gradeloom.functions.names.match_key`. The result gives each code to at
most one key and each key at most one code:

* exact: the key is the institution's own key;
* by tiers of distance over key length: in each tier every unmatched key asks for its nearest
  free code, by distance and then code; each code goes to its nearest asker, by distance and
  then key; repeated until nothing moves.

This is what walking over the keys one by one, each taking its nearest free code, gives for
the order in which our rounds settle them, but it does not depend on how rows are spread.

At four tenths of the length no piece of a key need be left whole, so there is nothing to join
near names on but the county. Distinct keys are therefore compared with distinct aliases in
tiles: a bounded number of keys against a bounded block of aliases, and inside a tile only pairs whose
letters allow it. A county of any size
spreads over many tasks, and no pair leaves its tile unless it is near:
a tile passes on the nearest few codes per key. Keys whose listed codes are all taken by others
are looked up again among the free ones, so the length of the lists never changes the result.

A tier needs no pairs farther than its own share of the length, and none of keys and codes that are
settled. So counties with many pairs of names are looked up anew for each tier: most keys are settled by
the narrow ones, where letters rule out nearly all pairs, and the wide ones see only what is left.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions import distance, rules
from gradeloom.functions.distance import near_pairs
from gradeloom.functions.names import county_of_id, match_key
from gradeloom.session import cut_lineage

# The tile function travels with its plan: executors need not have this package installed.
cloudpickle.register_pickle_by_value(distance)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ALIASES = 8192
TILE_KEYS = 2048
#: Codes listed for a key at first; the length changes no result. Long lists seldom run dry, and a refill costs a job.
LISTED_CODES = 32
#: Listed codes of a county that one task settles, to the end or until a list runs dry. Larger counties are
#: settled round by round; both ways give the same result.
SETTLED_PAIRS = 1_000_000
#: Counties with more pairs of keys and names are looked up tier by tier, the others once for all tiers.
PAIRS_FOR_ALL_TIERS = 4_000_000

KEY = ["county", "key"]
CODE = ["county", "code"]
_LISTS = "county string, key string, dists array<int>, codes array<string>, cut boolean"


def max_edits(key: Column | str, tenths: int) -> Column:
    length = F.length(F.col(key) if isinstance(key, str) else key)
    return F.floor(length * tenths / 10).cast("int")


def _key(name: str, county: str) -> Column:
    """Match key where neither part is null. Declared non-null, so that no null check makes
    Spark work it out a second time below a join."""
    return F.coalesce(match_key(name, county), F.lit(""))


def source_keys(schools: DataFrame, name: str, county: str) -> DataFrame:
    """Distinct match keys of school names. Names or counties that are null give none."""
    named = schools.dropna(subset=[name, county])
    return named.select(F.col(county).alias("county"), _key(name, county).alias("key")).distinct()


def match_targets(institutions: DataFrame, registry: DataFrame | None = None, high_school: bool = True) -> DataFrame:
    """Aliases ``(county, code, alias, is_primary, is_near)`` that keys are compared with.

    Institutions' own names (``is_primary``), all of them, and the registry's long names of the
    same code; in high-school mode only of schools with a high-school level. Near names are
    looked for among the registry's and one own name per code (``is_near``).
    """
    own = institutions.dropna(subset=["nume", "cod_judet", "cod_siiir"]).select(
        F.col("cod_judet").alias("county"), F.col("cod_siiir").alias("code"), _key("nume", "cod_judet").alias("alias"),
    ).distinct()
    last = own.groupBy(*CODE).agg(F.max("alias").alias("last"))
    targets = own.join(last, CODE).select(*CODE, "alias", F.lit(True).alias("is_primary"), (F.col("alias") == F.col("last")).alias("is_near"))
    if registry is None:
        return targets
    if high_school:
        registry = registry.filter(F.col("stare_liceal").isNotNull())
    named = registry.dropna(subset=["denumire_lunga_unitate", "judet_pj", "cod_siiir_unitate"])
    official = named.select(
        F.col("judet_pj").alias("county"), F.col("cod_siiir_unitate").alias("code"),
        _key("denumire_lunga_unitate", "judet_pj").alias("alias"),
    )
    # Their codes need no names worked out.
    known = institutions.dropna(subset=["nume"]).select(F.col("cod_judet").alias("county"), F.col("cod_siiir").alias("code"))
    extra = official.distinct().join(known, CODE, "left_semi")
    return targets.unionByName(extra.withColumn("is_primary", F.lit(False)).withColumn("is_near", F.lit(True)))


def codeless_keys(institutions: DataFrame) -> DataFrame:
    """Keys of institutions without a code: such a school is its own nearest one."""
    named = institutions.filter("cod_siiir IS NULL").dropna(subset=["nume", "cod_judet"])
    return named.select(F.col("cod_judet").alias("county"), _key("nume", "cod_judet").alias("key")).distinct()


def exact_matches(keys: DataFrame, targets: DataFrame) -> DataFrame:
    """Keys that equal an own name of an institution; of several codes the highest counts, and
    of several keys for a code the first."""
    own = (
        targets.filter("is_primary").groupBy("county", F.col("alias").alias("key"))
        .agg(F.max("code").alias("code"))
    )
    return keys.join(own, KEY).groupBy(*CODE).agg(F.min("key").alias("key")).select(*KEY, "code")


# -- near codes ---------------------------------------------------------------


def _tile_sizes(keys: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per county, over how many key tiles and alias blocks its comparison is spread."""
    n_alias = aliases.groupBy("county").agg(F.count("*").alias("n_alias"))
    n_key = keys.groupBy("county").agg(F.count("*").alias("n_key"))
    return n_alias.join(n_key, "county").select(
        "county",
        F.ceil(F.col("n_alias") / BLOCK_ALIASES).cast("int").alias("blocks"),
        F.ceil(F.col("n_key") / TILE_KEYS).cast("int").alias("tiles"),
    )


def _compare_tile(limit: int):
    """Function over the keys and aliases of one tile: the nearest ``limit + 1`` codes of each key, by distance and then code."""

    def compare(keys: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        if keys.empty or names.empty:
            return pd.DataFrame({"county": [], "key": [], "dist": [], "code": []})
        worth = names["codes"].map(len).to_numpy()
        row, column, dist = near_pairs(keys["key"].tolist(), names["alias"].tolist(), keys["k"].to_numpy(), limit + 1, worth)
        # Of each key the nearest limit + 1 names, and all as near as the last of them.
        order = np.lexsort((dist, row))
        sorted_row, sorted_dist = row[order], dist[order]
        first = np.searchsorted(sorted_row, sorted_row)
        last = np.minimum(first + limit, np.searchsorted(sorted_row, sorted_row, "right") - 1)
        kept = order[sorted_dist <= sorted_dist[last]]
        row, column, dist = row[kept], column[kept], dist[kept]
        # One row for each of their codes, and of these the nearest.
        number, texts = pd.factorize(np.concatenate(names["codes"].to_list()), sort=True)
        begin, many = (np.cumsum(worth) - worth)[column], worth[column]
        code = number[np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())]
        row, dist = np.repeat(row, many), np.repeat(dist, many)
        order = np.lexsort((code, dist, row))
        row, dist, code = row[order], dist[order], code[order]
        listed = np.arange(len(row)) - np.searchsorted(row, row) <= limit
        row, dist, code = row[listed], dist[listed], code[listed]
        return pd.DataFrame({
            "county": keys["county"].to_numpy()[row], "key": keys["key"].to_numpy()[row], "dist": dist.astype("int32"), "code": texts[code],
        })

    return compare


def _list_tile(limit: int):
    """The same, one row a key."""
    compare = _compare_tile(limit)

    def lists(keys: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        found = compare(keys, names)
        first = np.flatnonzero(found["key"].ne(found["key"].shift()))
        dists, codes = (np.split(found[c].to_numpy(), first[1:]) if len(first) else [] for c in ("dist", "code"))
        return found.iloc[first][KEY].assign(dists=_cells(dists), codes=_cells(codes))

    return lists


def _cells(lists: list[np.ndarray]) -> np.ndarray:
    return pd.Series(lists, dtype=object).to_numpy()


def _codes_of_names(targets: DataFrame, limit: int) -> DataFrame:
    """Of each alias the first ``limit + 1`` codes: no more can be listed, and one more shows the cut."""
    spelt = Window.partitionBy("county", "alias").orderBy("code")
    named = targets.select(*CODE, "alias").distinct().withColumn("nth", F.row_number().over(spelt))
    return (
        named.filter(F.col("nth") <= limit + 1)
        .groupBy("county", "alias").agg(F.array_sort(F.collect_list("code")).alias("codes"))
    )


def _nearest_lists(keys: DataFrame, targets: DataFrame, tenths: int, limit: int) -> DataFrame:
    """One row per key that has a near code: the first ``limit`` pairs of distance and code, and whether more exist."""
    aliases = _codes_of_names(targets, limit)
    grid = _tile_sizes(keys, aliases)
    blocks = (
        aliases.join(grid, "county")
        .withColumn("block", F.pmod(F.xxhash64("alias"), F.col("blocks")).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("county", "block", "tile", "alias", "codes")
    )
    tiles = (
        keys.join(grid, "county")
        .withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("county", "block", "tile", "key", max_edits("key", tenths).alias("k"))
    )
    # Comparing costs far more than the rows weigh, so the number of tasks is given: left to
    # itself Spark would merge the small shuffle into a few of them.
    tasks = 4 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ["county", "block", "tile"]
    near = (
        tiles.repartition(tasks, *spread).groupBy(*spread)
        .cogroup(blocks.repartition(tasks, *spread).groupBy(*spread))
        .applyInPandas(_list_tile(limit), "county string, key string, dists array<int>, codes array<string>")
    )
    pairs = F.flatten(F.collect_list(F.arrays_zip("dists", "codes")))
    return _cut_to(near.groupBy(*KEY).agg(F.sort_array(pairs).alias("pairs")), limit)


def _equal_lists(keys: DataFrame, targets: DataFrame, limit: int) -> DataFrame:
    """The same at distance zero, which needs no comparing."""
    named = keys.join(_codes_of_names(targets, limit).withColumnRenamed("alias", "key"), KEY)
    return _cut_to(named.select(*KEY, F.transform("codes", lambda c: F.struct(F.lit(0).alias("dists"), c.alias("codes"))).alias("pairs")), limit)


def _cut_to(lists: DataFrame, limit: int) -> DataFrame:
    first = F.slice("pairs", 1, limit)
    return lists.select(
        *KEY, F.transform(first, lambda p: p["dists"]).alias("dists"), F.transform(first, lambda p: p["codes"]).alias("codes"),
        (F.size("pairs") > limit).alias("cut"),
    )


def _one_row_a_code(lists: DataFrame) -> DataFrame:
    pairs = lists.select(*KEY, "cut", F.explode(F.arrays_zip("dists", "codes")).alias("p"))
    return pairs.groupBy(*KEY, F.col("p.codes").alias("code")).agg(F.min("p.dists").alias("dist"), F.bool_or("cut").alias("cut"))


def nearest_codes(keys: DataFrame, targets: DataFrame, tenths: int, limit: int) -> DataFrame:
    """The nearest codes of each key within ``tenths`` of its length.

    The first ``limit`` pairs per key, by distance and then code, reduced to one row per code;
    ``cut`` is true on every row of a key for which more pairs exist.
    """
    return _one_row_a_code(_nearest_lists(keys, targets, tenths, limit))


def equal_codes(keys: DataFrame, targets: DataFrame) -> DataFrame:
    """Codes with an alias equal to the key; the complete list at distance zero."""
    named = targets.select(*CODE, F.col("alias").alias("key")).distinct()
    return keys.join(named, KEY).select(*KEY, "code", F.lit(0).alias("dist"), F.lit(False).alias("cut"))


# -- assignment ---------------------------------------------------------------


def _settle(live: DataFrame, tenths: int) -> DataFrame:
    """One round: every key asks for its nearest code, every code takes its nearest asker."""
    asked = live.groupBy(*KEY).agg(F.min(F.struct("dist", "code")).alias("b")).select(*KEY, "b.dist", "b.code")
    asked = asked.filter(F.col("dist") * 10 <= F.length("key") * tenths)
    taken = asked.groupBy(*CODE).agg(F.min(F.struct("dist", "key")).alias("w"))
    return taken.select("county", F.col("w.key").alias("key"), "code", F.col("w.dist").alias("dist"))


def _still_live(live: DataFrame, won: DataFrame) -> DataFrame:
    return live.join(won.select(*KEY), KEY, "left_anti").join(won.select(*CODE), CODE, "left_anti")


def _settle_lists(tiers: list[int], few: int):
    """Function over the lists of a county: the same rounds as ``_settle``, to the end or until a cut list has run dry.

    Gives settled keys with their code, and, where it had to stop, the keys still asking (tier -1) with the listed
    codes that are free; ``wants`` is true for those with a cut list of at most ``few``.
    """

    def settle(lists: pd.DataFrame) -> pd.DataFrame:
        lists = lists.sort_values("key", ignore_index=True)  # so the number of a key tells its place in the order
        sizes = lists["codes"].map(len).to_numpy()
        code, texts = pd.factorize(np.concatenate(lists["codes"].to_list()), sort=True)
        dist, cut = np.concatenate(lists["dists"].to_list()), lists["cut"].to_numpy()
        length, end = lists["key"].str.len().to_numpy(), np.cumsum(sizes)
        at, last = end - sizes, dist[end - 1]
        taken, asking, stopped = np.zeros(len(texts), dtype=bool), np.arange(len(lists)), False
        won: list[tuple[np.ndarray, int]] = []
        for tenths in tiers:
            while not stopped:
                moving = asking
                while len(moving):
                    moving = moving[at[moving] < end[moving]]
                    moving = moving[taken[code[at[moving]]]]
                    at[moving] += 1
                dry = at[asking] == end[asking]
                # What a cut list would go on with is no nearer than its last code.
                if (cut[asking] & dry & (last[asking] * 10 <= length[asking] * tenths)).any():
                    stopped = True
                    break
                able = asking[~dry]
                able = able[dist[at[able]] * 10 <= length[able] * tenths]
                if not len(able):
                    break
                wish = code[at[able]]
                order = np.lexsort((able, dist[at[able]], wish))
                able, wish = able[order], wish[order]
                winners = able[np.concatenate([[True], wish[1:] != wish[:-1]])]
                taken[code[at[winners]]] = True
                won.append((winners, tenths))
                asking = np.setdiff1d(asking, winners, assume_unique=True)
        done = np.concatenate([w for w, _ in won] or [asking[:0]])
        rest = asking if stopped else asking[:0]
        rest = rest[cut[rest] | (at[rest] < end[rest])]
        free = [np.flatnonzero(~taken[code[a:e]]) + a for a, e in zip(at[rest], end[rest], strict=True)]
        kept = [at[done[n:n + 1]] for n in range(len(done))] + free
        rows = np.concatenate([done, rest])
        return lists.iloc[rows][KEY].assign(
            dists=_cells([dist[k] for k in kept]), codes=_cells([texts[code[k]] for k in kept]), cut=cut[rows],
            tier=np.concatenate([np.full(len(w), t) for w, t in won] + [np.full(len(rest), -1)]).astype("int32"),
            wants=cut[rows] & (np.arange(len(rows)) >= len(done)) & (np.array([len(k) for k in kept], dtype=int) <= few),
        )

    return settle


def _settle_by_rounds(lists: DataFrame, targets: DataFrame, tiers: list[int], limit: int) -> DataFrame:
    """The counties of ``lists`` settled in rounds, whose pairs are written to the shared folder after each."""
    look_up = _look_up(max(tiers))
    live, settled = cut_lineage(_one_row_a_code(lists)), None
    lists_cut = not live.filter("cut").isEmpty()
    for tenths in tiers:
        while True:
            won = cut_lineage(_settle(live, tenths).withColumn("tier", F.lit(tenths)))
            if won.isEmpty():
                break
            settled = won if settled is None else settled.unionByName(won)
            left = _still_live(live, won)
            if lists_cut:
                # Every key asks for its true nearest free code: refill the lists that ran dry.
                waiting = live.filter("cut").select(*KEY).distinct().join(won, KEY, "left_anti")
                dry = cut_lineage(waiting.join(left, KEY, "left_anti"))
                if not dry.isEmpty():
                    left = left.unionByName(_one_row_a_code(look_up(dry, targets.join(settled, CODE, "left_anti"), limit)))
            live = cut_lineage(left)
    return won if settled is None else settled


def _look_up(widest: int):
    def look_up(keys: DataFrame, free: DataFrame, limit: int) -> DataFrame:
        return _nearest_lists(keys, free, widest, limit) if widest else _equal_lists(keys, free, limit)

    return look_up


def _settle_all(keys: DataFrame, targets: DataFrame, tiers: list[int], limit: int) -> DataFrame:
    """All rounds of ``tiers``. A county is settled by a task that stops when a list has run dry; lists that are
    dry, or nearly so, are then looked up again among the free codes, longer each time."""
    look_up, found, few, free = _look_up(max(tiers)), [], limit // 4, targets
    lists = cut_lineage(look_up(keys, targets, limit))
    while True:
        sizes = lists.groupBy("county").agg(F.sum(F.size("codes")).alias("pairs"))
        large = [r["county"] for r in sizes.filter(F.col("pairs") > SETTLED_PAIRS).collect()]
        is_large = F.col("county").isin(large)
        if large:
            found.append(_settle_by_rounds(lists.filter(is_large), free, tiers, limit))
        state = cut_lineage(lists.filter(~is_large).groupBy("county").applyInPandas(
            _settle_lists(tiers, few), _LISTS + ", tier int, wants boolean"
        ))
        found.append(state.filter("tier >= 0").select(*KEY, F.col("codes")[0].alias("code"), F.col("dists")[0].alias("dist"), "tier"))
        settled = reduce(DataFrame.unionByName, found)
        waiting = state.filter("wants").select(*KEY)
        most = waiting.groupBy("county").count().agg(F.max("count")).first()[0]
        if not most:
            return cut_lineage(settled)
        limit = max(limit, min(4 * limit, SETTLED_PAIRS // (2 * most)))
        free = cut_lineage(targets.join(settled, CODE, "left_anti"))
        again = look_up(cut_lineage(waiting), free, limit)
        lists = cut_lineage(state.filter("tier < 0 AND NOT wants").select("county", "key", "dists", "codes", "cut").unionByName(again))


def fuzzy_matches(
    keys: DataFrame, targets: DataFrame, tiers: list[int] = rules.HIGH_SCHOOL_TIERS, limit: int = LISTED_CODES
) -> DataFrame:
    """One-to-one ``(county, key, code, dist, tier)`` for keys and codes still unmatched."""
    keys, targets = cut_lineage(keys), cut_lineage(targets)
    n_key, n_alias = keys.groupBy("county").agg(F.count("*").alias("n_key")), targets.groupBy("county").agg(F.count_distinct("alias").alias("n_alias"))
    counties = n_key.join(n_alias, "county").collect()
    wide = [r["county"] for r in counties if max(tiers) and r["n_key"] * r["n_alias"] > PAIRS_FOR_ALL_TIERS]
    is_wide, parts = F.col("county").isin(wide), []
    if len(wide) < len(counties) or not wide:
        parts.append(_settle_all(keys.filter(~is_wide), targets.filter(~is_wide), tiers, limit))
    if wide:
        # Lists of a very large county are shorter, so that it is settled by a task as long as that can be.
        limit = max(min(8, limit), min(limit, SETTLED_PAIRS // max(r["n_key"] for r in counties if r["county"] in wide)))
        asking, free = keys.filter(is_wide), targets.filter(is_wide)
        for tenths in tiers:
            parts.append(_settle_all(asking, free, [tenths], limit))
            if tenths != tiers[-1]:
                asking, free = cut_lineage(asking.join(parts[-1], KEY, "left_anti")), cut_lineage(free.join(parts[-1], CODE, "left_anti"))
    return reduce(DataFrame.unionByName, parts)


def match_schools(
    schools: DataFrame, name: str, county: str, institutions: DataFrame,
    registry: DataFrame | None = None, high_school: bool = True,
) -> DataFrame:
    """``(county, key, code, dist, tier)`` for distinct school names; tier is null when exact.

    Names of institutions that have no code themselves get none from a neighbour.
    """
    return _matched(
        source_keys(schools, name, county), match_targets(institutions, registry, high_school), codeless_keys(institutions), high_school
    )


def match_schools_by_year(
    schools: DataFrame, year: str, years: list[int], name: str, county: str, institutions: DataFrame,
    registry: DataFrame | None = None, high_school: bool = True,
) -> DataFrame:
    """The same for the names of several years at once, each year on its own: names of one year compete for
    the codes. Institutions are copied once for each of ``years``. Adds the column ``year``."""
    named = schools.dropna(subset=[year, name, county])
    keys = named.select(F.col(year).alias("_year"), F.col(county).alias("county"), _key(name, county).alias("key")).distinct()
    each = F.explode(F.array(*[F.lit(y) for y in years])).alias("_year")

    def block(df: DataFrame) -> DataFrame:
        return df.withColumn("county", F.concat_ws("|", "_year", "county")).drop("_year")

    targets, codeless = match_targets(institutions, registry, high_school), codeless_keys(institutions)
    found = _matched(block(keys), block(targets.select("*", each)), block(codeless.select("*", each)), high_school)
    return found.select(
        F.split_part("county", F.lit("|"), F.lit(1)).cast("int").alias(year), F.expr("substr(county, instr(county, '|') + 1)").alias("county"),
        "key", "code", "dist", "tier",
    )


def _matched(keys: DataFrame, targets: DataFrame, codeless: DataFrame, high_school: bool) -> DataFrame:
    keys, targets = cut_lineage(keys), cut_lineage(targets)
    exact = cut_lineage(
        exact_matches(keys, targets).withColumns({"dist": F.lit(0), "tier": F.lit(None).cast("int")})
    )
    tiers = rules.HIGH_SCHOOL_TIERS if high_school else rules.MIDDLE_SCHOOL_TIERS
    asking = keys.join(exact, KEY, "left_anti").join(codeless, KEY, "left_anti")
    fuzzy = fuzzy_matches(asking, targets.filter("is_near").join(exact, CODE, "left_anti"), tiers)
    return exact.unionByName(fuzzy)


def unmatched_schools(schools: DataFrame, name: str, county: str, matches: DataFrame) -> DataFrame:
    return source_keys(schools, name, county).join(matches, KEY, "left_anti")


def attach_codes(
    facts: DataFrame, matches: DataFrame, name: str, county: str, code: str, only_missing: bool = True, by: list[str] = []
) -> DataFrame:
    """Matched codes on fact rows. Matches with further columns ``by`` (a year) count for rows with the same values.

    ``only_missing`` keeps codes already there (origin school); otherwise the column holds the
    matched code or null (placement school). Keys are worked out once per distinct school, and
    that table, not the facts, is joined with the matches.
    """
    schools = facts.select(*by, name, county).dropna().distinct()
    codes = (
        schools.select(*by, name, county, F.col(county).alias("county"), match_key(name, county).alias("key"))
        .join(matches.select(*by, *KEY, F.col("code").alias("_code")), [*by, *KEY])
        .select(*by, name, county, "_code")
    )
    old = F.col(code) if only_missing and code in facts.columns else F.lit(None).cast("string")
    columns = facts.columns if code in facts.columns else facts.columns + [code]
    joined = facts.join(codes, [*by, name, county], "left")
    return joined.withColumn(code, F.coalesce(old, F.col("_code"))).select(*columns)


def backfill_codes(institutions: DataFrame, matches: DataFrame) -> DataFrame:
    """Institutions without a code and the code found for each by name.

    ``owner`` is an institution that already has the code; ``accepted`` is true when none has.
    """
    county = county_of_id("id")
    wanting = institutions.filter(F.col("cod_siiir").isNull()).select(
        "id", "nume", county.alias("county"), match_key("nume", county).alias("key")
    )
    owners = institutions.dropna(subset=["cod_siiir"]).groupBy(F.col("cod_siiir").alias("code")).agg(
        F.min("id").alias("owner")
    )
    found = wanting.join(matches.select(*KEY, "code"), KEY).join(owners, "code", "left")
    return found.select("id", "nume", "code", "owner", F.col("owner").isNull().alias("accepted"))


def apply_backfill(institutions: DataFrame, backfill: DataFrame) -> DataFrame:
    new = backfill.filter("accepted").select("id", F.col("code").alias("_code"))
    filled = institutions.join(new, "id", "left").withColumn("cod_siiir", F.coalesce("cod_siiir", "_code"))
    return filled.select(*institutions.columns)
