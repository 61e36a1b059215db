"""The views of ``catalog.views`` in SQL, and SQL forms of the name rules."""

from __future__ import annotations

from gradeloom.functions import rules

def padded(number: str, width: int) -> str:
    text = f"cast({number} AS string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) AS int), '0')"


RESULTS = f"""
l AS (
  SELECT l_orderkey AS k, l_linenumber AS n, max(l_partkey) AS pk
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
g AS (SELECT k, n, pk, 100 + (pk * 37 + n * 101) % 901 AS h FROM l),
t AS (
  SELECT k, n,
    CASE WHEN pk % 97 = 0 THEN '-'
         ELSE concat(cast(cast(floor(h / 100) AS int) AS string), '.', lpad(cast(h % 100 AS string), 2, '0')) END AS first_mark,
    CASE WHEN pk % 5 = 0 AND h <= 975
         THEN concat(cast(cast(floor((h + 25) / 100) AS int) AS string), '.', lpad(cast((h + 25) % 100 AS string), 2, '0'))
         ELSE '' END AS appeal
  FROM g),
results AS (
SELECT cast(year(o_orderdate) AS int) AS an, o_orderkey AS ord,
  concat('J', substr('ABCDEFGHIJKLMNOPQRSTUVWXY', c_nationkey + 1, 1), {padded('o_orderkey', 7)}) AS cod_candidat,
  CASE WHEN o_orderkey % 101 = 0 THEN 'x' WHEN o_orderkey % 2 = 0 THEN 'Masculin' ELSE 'f' END AS sex,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL
       WHEN o_orderkey % 7 = 0 THEN '1990-1991'
       ELSE concat(cast(year(o_orderdate) - 1 AS string), '-', cast(year(o_orderdate) AS string)) END AS promotie,
  concat('Liceul „', c_mktsegment, '” Nr. ', cast(o_custkey % 40 AS string)) AS unitate_nume,
  concat('J', substr('ABCDEFGHIJKLMNOPQRSTUVWXY', c_nationkey + 1, 1)) AS unitate_cod_judet,
  CASE WHEN o_custkey % 11 = 0 THEN NULL
       ELSE concat('016', cast(1 + o_custkey % 2 AS string), cast(1 + o_custkey % 3 AS string), {padded('o_custkey', 4)}, '0') END AS unitate_siiir,
  max(CASE WHEN n = 1 THEN first_mark END) AS lr_init, max(CASE WHEN n = 1 THEN appeal END) AS lr_cont,
  CASE WHEN o_orderkey % 6 = 0 THEN 'Limba 1' WHEN o_orderkey % 6 = 1 THEN '-' ELSE '' END AS limba_materna,
  max(CASE WHEN n = 4 AND o_orderkey % 6 = 0 THEN first_mark END) AS lm_init,
  max(CASE WHEN n = 2 THEN first_mark END) AS do_init, max(CASE WHEN n = 2 THEN appeal END) AS do_cont,
  max(CASE WHEN n = 3 THEN first_mark END) AS da_init, max(CASE WHEN n = 3 THEN appeal END) AS da_cont,
  CASE WHEN o_orderkey % 211 = 0 THEN 'Amânat' WHEN o_orderkey % 40 = 0 THEN 'Eliminat din examen'
       WHEN o_orderstatus = 'F' THEN 'REUSIT' WHEN o_orderstatus = 'O' THEN 'Respins' ELSE 'Neprezentat' END AS rezultat,
  CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE concat('<b>Liceul ', c_mktsegment, '</b><br/>Real/Liceal/Zi') END AS repartizat_liceu_nume,
  CASE WHEN o_orderkey % 8 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'Nerepartizat'
       ELSE concat('<b>(', cast(100 + o_custkey % 300 AS string), ') Profil ', o_orderpriority, '</b><br/>Limba A',
                   CASE WHEN o_orderkey % 5 = 0 THEN ' / Limba B' ELSE '' END) END AS repartizat_specializare
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN t ON t.k = o_orderkey
GROUP BY o_orderdate, o_orderkey, c_nationkey, c_mktsegment, o_custkey, o_orderstatus, o_orderpriority)
"""

_COUNTY_OF_BRAND = "concat('J', substr('ABCDEFGHIJKLMNOPQRSTUVWXY', cast(substr(p_brand, 7) AS int), 1))"

INSTITUTIONS = f"""
institutions AS (
SELECT p_partkey AS id, {_COUNTY_OF_BRAND} AS cod_judet,
  concat('Școala „', p_name, '” ', p_type, ' Nr. ', cast(p_size AS string)) AS nume,
  CASE WHEN p_partkey % 10 = 0 THEN NULL
       ELSE concat('0161', cast(1 + p_partkey % 3 AS string), {padded('p_partkey', 4)}, '0') END AS cod_siiir
FROM part)
"""

REGISTRY = """
registry AS (
SELECT cod_siiir AS cod_siiir_unitate, replace(replace(nume, '„', ''), '”', '') AS denumire_lunga_unitate,
  cod_judet AS judet_pj, CASE WHEN id % 2 = 0 THEN 'da' END AS stare_liceal
FROM institutions WHERE cod_siiir IS NOT NULL)
"""

SOURCE_SCHOOLS = f"""
source_schools AS (
SELECT DISTINCT {_COUNTY_OF_BRAND} AS cod_judet,
  CASE WHEN p_partkey % 4 = 0 THEN concat('SCOALA ', upper(p_name), ' ', p_type, ' NR ', cast(p_size AS string))
       WHEN p_partkey % 4 = 1 THEN concat('Şcoala ''', replace(p_name, 'l', ''), ''' ', p_type, ' Nr.', cast(p_size AS string))
       WHEN p_partkey % 4 = 2 THEN concat('Scoala ', p_type, ' ', p_name, ' ', cast(p_size + 1 AS string))
       ELSE concat('Școala ,,', p_name, '" ', p_type, ' Nr. ', cast(p_size AS string)) END AS nume
FROM part)
"""

_COUNTY_NAMES = "[" + ", ".join(f"'JUD. {c[2].upper()}'" for c in rules.COUNTIES) + "]"


def county_text(number: str) -> str:
    return f"{_COUNTY_NAMES}[cast(({number}) % 42 + 1 AS int)]"


COUNTIES = "counties AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{c[0]}', '{c[1]}')" for i, c in enumerate(rules.COUNTIES, start=1)
) + ") v(pos, code, plain))"

OLD_REGISTRIES = f"""
first_registry AS (
SELECT p_partkey AS nr_crt, {padded('p_partkey // 3', 10)} AS cod_siiir,
  concat('Liceul ', p_name, ' ', cast(p_size AS string)) AS nume_unitate, {county_text('p_partkey')} AS judet FROM part WHERE (p_partkey // 3) % 7 <> 0),
second_registry AS (
SELECT p_partkey AS nr_crt, cast(p_partkey // 2 AS string) AS cod_sirues,
  concat('Grup Liceul ', p_name, ' ', cast(p_size AS string)) AS nume_unitate, {county_text('p_partkey + 7')} AS judet FROM part WHERE (p_partkey // 2) % 7 <> 0)
"""

DETAILS = f"""
details AS (
SELECT s_suppkey AS aux_id, {padded('s_suppkey', 10)} AS cod, concat(' Str. ', s_name, ',') AS strada,
  ['-', '12', ' x ', '7 bis.', ''][cast(s_suppkey % 5 + 1 AS int)] AS nr_strada,
  CASE WHEN s_suppkey % 6 <> 0 THEN concat(n_name, '-VALE') END AS localitate,
  CASE WHEN s_suppkey % 4 <> 0 THEN {padded('s_suppkey * 7', 6)} END AS cod_postal,
  CASE WHEN s_suppkey % 3 = 0 THEN '' WHEN s_suppkey % 3 = 1 THEN concat('www.s', cast(s_suppkey AS string), '.example') END AS website,
  CASE WHEN s_suppkey % 2 = 0 THEN concat('07', {padded('s_suppkey', 8)}) END AS telefon,
  CASE WHEN s_suppkey % 5 <> 0 THEN cast(s_suppkey * 13 AS string) END AS cod_fiscal
FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""

LISTED = f"""
listed AS (
SELECT c_custkey AS id, concat(c_mktsegment, ' Nr. ', cast(c_custkey AS string)) AS nume,
  CASE WHEN c_custkey % 9 <> 0 THEN {padded('c_custkey // 10', 10)} END AS cod_siiir,
  CASE WHEN c_custkey % 4 = 0 THEN 'Str. Veche 1' WHEN c_custkey % 4 = 1 THEN '' END AS adresa,
  CASE WHEN c_custkey % 5 = 0 THEN 'www.vechi.example' END AS website,
  CASE WHEN c_custkey % 7 = 0 THEN '0700' END AS telefon, cast(NULL AS varchar) AS cod_fiscal
FROM customer)
"""

ALIASES = """
aliases AS (
SELECT cast(c_custkey AS string) AS alternativ, cast(c_custkey + 1 AS string) AS corect
FROM customer WHERE c_custkey % 10 <> 9 AND c_custkey % 4 <> 0)
"""

NUMBERED = """
numbered AS (
SELECT o_orderkey // 5000 AS set_no, (o_orderkey % 5000) // 20 + 1 AS page_no, o_orderkey % 20 AS row_no,
  cast(o_orderkey % 5000 + 1 AS string) AS crt, o_orderpriority AS value
FROM orders)
"""

FOUND = "found_rows AS (SELECT * FROM numbered WHERE (set_no * 5000 + (page_no - 1) * 20 + row_no) % 997 <> 0)"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _chain(x: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        x = f"replace({x}, {_quoted(old)}, {_quoted(new)})"
    return x


def _let(value: str, body: str) -> str:
    """``body`` with ``v`` bound to ``value`` once."""
    return f"(list_transform([{value}], lambda v: {body}))[1]"


def repair(x: str) -> str:
    text = _chain(_chain(x, rules.MOJIBAKE), rules.QUOTES)
    pair_or_none = "length(v) - length(replace(v, '\"', '')) IN (0, 2)"
    kept = _let(text, f"CASE WHEN {pair_or_none} THEN v ELSE replace(v, '\"', '') END")
    return f"translate({kept}, '{rules.CEDILLA}', '{rules.COMMA_BELOW}')"


def plain(x: str) -> str:
    singles = "".join(a for a, _ in rules.PLAIN_LETTERS), "".join(b for _, b in rules.PLAIN_LETTERS)
    return f"translate(strip_accents({_chain(x, rules.PLAIN_LIGATURES)}), '{singles[0]}', '{singles[1]}')"


def canonical_name(x: str) -> str:
    # Upper case of the sharp s is SS.
    text = _chain(f"upper(replace(replace({repair(x)}, '_', ' '), 'ß', 'SS'))", rules.PLACES)
    return f"regexp_replace(regexp_replace({text}, ' +', ' ', 'g'), '^\\s+|\\s+$', '', 'g')"


def canonical_id(x: str, county: str, places: bool = True) -> str:
    text = f"regexp_replace({plain(f'replace({repair(x)}, $$_$$, $$ $$)')}, '[^a-zA-Z0-9 ]+', ' ', 'g')"
    text = f"upper({text} || ' ' || {county})"
    if places:
        text = _chain(text, rules.PLACES)
    return f"replace(trim(regexp_replace({text}, ' +', ' ', 'g')), ' ', '_')"


def match_key(x: str, county: str) -> str:
    words = _let(canonical_id(x, county), f"substr(v, 1, greatest(length(v) - length({county}) - 1, 0))")
    return f"regexp_replace({county} || '_' || {words}, '([0-9])', '{chr(92)}1{(chr(92) + '1') * 9}', 'g')"


def fold_key(x: str, county: str) -> str:
    return f"replace(replace({canonical_id(x, county)}, '_', ''), 'A', 'I')"


def display_name(x: str) -> str:
    text = canonical_name(_chain(f"upper(replace({x}, 'ß', 'SS'))", rules.OLD_SPELLINGS))
    kept = " ".join(
        f"WHEN {plain('lower(w)')} = {_quoted(plain_py(word))} THEN {_quoted(word)}" for word in rules.KEPT_WORDS
    )
    word = f"CASE {kept} ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END"
    words = f"regexp_extract_all({text}, '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_]+')"
    joined = f"array_to_string(list_transform({words}, lambda w: {word}), '')"
    curly = _let(joined, """CASE WHEN length(v) - length(replace(v, '"', '')) = 2
        THEN split_part(v, '"', 1) || '„' || split_part(v, '"', 2) || '”' || split_part(v, '"', 3) ELSE v END""")
    return _let(curly, "CASE WHEN contains(v, '”') AND right(v, 1) <> '”' "
                       "THEN replace(replace(v, '”', '”,'), ',,', ',') ELSE v END")


def plain_py(word: str) -> str:
    return word.lower().replace("ș", "s")


def county_of(text: str) -> str:
    """Correlated lookup: first county in list order named in the text."""
    return f"(SELECT arg_min(code, pos) FROM counties WHERE contains(upper({plain(text)}), plain))"


def grade(x: str) -> str:
    return f"""CASE WHEN regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$')
        AND try_cast(trim({x}) AS double) BETWEEN 1 AND 10 THEN try_cast(trim({x}) AS double) END"""


MARKS = f"""
marks AS (
SELECT *, {grade('lr_init')} AS lr_i, {grade('lr_cont')} AS lr_c, {grade('lm_init')} AS lm_f,
  {grade('do_init')} AS do_i, {grade('do_cont')} AS do_c, {grade('da_init')} AS da_i, {grade('da_cont')} AS da_c,
  nullif(limba_materna, '') AS lang FROM results),
finals AS (
SELECT *, coalesce(lr_c, lr_i) AS lr, coalesce(do_c, do_i) AS dob, coalesce(da_c, da_i) AS da FROM marks),
means AS (
SELECT *,
  CASE WHEN lm_f IS NOT NULL THEN floor((round(lr * 100) + round(dob * 100) + round(da * 100) + round(lm_f * 100)) / 4) / 100
       WHEN lang IS NULL THEN floor((round(lr * 100) + round(dob * 100) + round(da * 100)) / 3) / 100 END AS medie,
  CASE WHEN lm_f IS NOT NULL THEN floor((round(lr * 100) + round(dob * 100) + round(lm_f * 100)) / 3) / 100
       WHEN nullif(lang, '-') IS NULL THEN floor((round(lr * 100) + round(dob * 100)) / 2) / 100 END AS medie_en
FROM finals)
"""


def fixed_code(c: str) -> str:
    stem = f"(substr({c}, 1, 3) || '12' || substr({c}, 6, 4))"
    total = " + ".join(
        f"try_cast(substr(v, {i}, 1) AS int) * {w}" for i, w in enumerate(rules.SCHOOL_CODE_WEIGHTS, start=1)
    )
    digit = f"CASE WHEN ({total}) % 9 = 0 THEN 9 ELSE ({total}) % 9 END"
    recomputed = _let(stem, f"v || cast({digit} AS string)")
    plain_fix = f"substr({c}, 1, 3) || '1' || substr({c}, 5)"
    return f"CASE WHEN length({c}) = 10 THEN CASE WHEN substr({c}, 5, 1) = '3' THEN {recomputed} ELSE {plain_fix} END END"


RESULT_LABEL = """CASE lower(rezultat) WHEN 'reusit' THEN 'promovat' WHEN 'respins' THEN 'nepromovat'
  WHEN 'neprezentat' THEN 'absent' WHEN 'eliminat din examen' THEN 'eliminat' WHEN 'promovat' THEN 'promovat'
  WHEN 'nepromovat' THEN 'nepromovat' WHEN 'absent' THEN 'absent' WHEN 'eliminat' THEN 'eliminat'
  WHEN 'neevaluat' THEN 'neevaluat' END"""
EARLIER = "promotie IS DISTINCT FROM (cast(an - 1 AS string) || '-' || cast(an AS string))"
SEX = "CASE lower(sex) WHEN 'masculin' THEN 'm' WHEN 'feminin' THEN 'f' WHEN 'm' THEN 'm' WHEN 'f' THEN 'f' END"


def sql(*views: str, select: str) -> str:
    """One statement from view texts and a final select."""
    return "WITH " + ",".join(v.strip() for v in views) + "\n" + select.strip()
