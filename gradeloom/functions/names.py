"""School-name clean-up, identifiers, match keys and display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradeloom.functions import rules
from gradeloom.functions._columns import ColumnLike, bind, col, lookup, replace_all, strip

_ACCENTS_FROM, _ACCENTS_TO = rules.accent_table()

# Runs of word characters and the text between them.
_WORDS_AND_GAPS = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"
_LETTERS_AND_GAPS = r"(\p{L}+|[^\p{L}]+)"


_SCRIPTS, _SPELLED_OUT = rules.script_table()


def plain_letters(c: ColumnLike) -> Column:
    """Latin text without accents; letters of other alphabets are spelled out. Scripts without letters (signs
    for words or syllables) stay as they are."""

    def latin(text: Column) -> Column:
        spelled = F.translate(replace_all(text, _SPELLED_OUT), *_SCRIPTS)
        return F.when(text.rlike(rules.OTHER_SCRIPTS), spelled).otherwise(text)

    return F.translate(replace_all(bind(col(c), latin), rules.PLAIN_LIGATURES), _ACCENTS_FROM, _ACCENTS_TO)


def _repair_quotes(c: Column) -> Column:

    def paired(text: Column) -> Column:
        bare = F.replace(text, F.lit('"'), F.lit(""))
        kept = (F.length(text) - F.length(bare)).isin(0, 2)
        return F.when(kept, text).otherwise(bare)

    return bind(replace_all(replace_all(c, rules.MOJIBAKE), rules.QUOTES), paired)


def repair_encoding(c: ColumnLike) -> Column:
    """Undo wrong decoding, unify quotes and Romanian letters; drop unpaired quotes."""
    return F.translate(_repair_quotes(col(c)), rules.CEDILLA, rules.COMMA_BELOW)


def _abbreviate_places(c: Column) -> Column:
    return replace_all(c, rules.PLACES)


def canonical_name(name: ColumnLike, county: ColumnLike, place_rules: bool = True) -> Column:
    """Upper-case display form of a name; null when the name or the county is null."""
    text = F.upper(F.replace(repair_encoding(name), F.lit("_"), F.lit(" ")))
    if place_rules:
        text = _abbreviate_places(text)
    text = strip(F.regexp_replace(text, " {2,}", " "))
    return F.when(col(county).isNotNull(), text)


def _plain_words(name: ColumnLike) -> Column:
    text = F.replace(_repair_quotes(col(name)), F.lit("_"), F.lit(" "))
    return F.regexp_replace(plain_letters(text), "[^a-zA-Z0-9 ]+", " ")


def _as_id(text: Column, place_rules: bool = True) -> Column:
    text = F.upper(text)
    if place_rules:
        text = _abbreviate_places(text)
    text = F.trim(F.regexp_replace(text, " {2,}", " "))
    return F.replace(text, F.lit(" "), F.lit("_"))


def canonical_id(name: ColumnLike, county: ColumnLike, place_rules: bool = True) -> Column:
    """ASCII identifier ``NAME_WORDS_COUNTY``."""
    return _as_id(F.concat(_plain_words(name), F.lit(" "), col(county)), place_rules)


def match_key(name: ColumnLike, county: ColumnLike) -> Column:
    """County first, and each digit ten times, so that a wrong digit weighs ten edits."""
    key = F.concat(col(county), F.lit("_"), _as_id(_plain_words(name)))
    return F.regexp_replace(key, "([0-9])", "$1" * 10)


def fold_key(name: ColumnLike, county: ColumnLike) -> Column:
    """Identifier in which the two spellings of one vowel, and word breaks, do not count."""
    return F.translate(canonical_id(name, county), "A_", "I")


def same_name(proposed: ColumnLike, original: ColumnLike) -> Column:
    """True when two names differ only in accents, quotes, breaks or the folded vowel."""
    return fold_key(proposed, F.lit("X")) == fold_key(original, F.lit("X"))


def same_name_as_id(proposed: ColumnLike, school_id: ColumnLike) -> Column:
    """Older form of :func:`same_name`: the name against an identifier."""
    school_id = col(school_id)
    own = canonical_id(proposed, county_of_id(school_id), place_rules=False)
    return F.translate(own, "A", "I") == F.translate(school_id, "A", "I")


def county_of_id(school_id: ColumnLike) -> Column:
    return F.element_at(F.split(col(school_id), "_"), -1)


def pretty_quotes(c: ColumnLike) -> Column:
    """Exactly two straight quotes become an opening and a closing one."""
    c = col(c)
    return F.regexp_replace(c, r'(?s)^([^"]*)"([^"]*)"([^"]*)$', "$1„$2”$3")


def _display_word(word: Column) -> Column:
    kept = {_fold_word(w): w for w in rules.KEPT_WORDS}
    low = F.lower(word)
    # No kept word is longer than six letters, so longer ones skip the tables, and ASCII ones that of accents.
    plain = F.when(F.octet_length(low) == F.length(low), low).otherwise(plain_letters(low))
    exception = F.when(F.length(word) <= 6, lookup(plain, kept))
    return F.coalesce(exception, F.initcap(word))


def _fold_word(word: str) -> str:
    return word.lower().translate(str.maketrans(_ACCENTS_FROM[: len(_ACCENTS_TO)], _ACCENTS_TO))


def display_name(name: ColumnLike) -> Column:
    """Readable name: capitals per word, fixed connectives, curly quotes, comma after them."""
    text = replace_all(F.upper(col(name)), rules.OLD_SPELLINGS)
    text = canonical_name(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(_WORDS_AND_GAPS), 1)
    text = pretty_quotes(F.array_join(F.transform(words, _display_word), ""))

    def comma_after_quote(t: Column) -> Column:
        with_comma = F.replace(F.replace(t, F.lit("”"), F.lit("”,")), F.lit(",,"), F.lit(","))
        return F.when(t.contains("”") & ~t.endswith("”"), with_comma).otherwise(t)

    return bind(text, comma_after_quote)


def display_name_old(name: ColumnLike) -> Column:
    """Older rule: capitals per word, connectives in lower case, nothing else."""

    def word_form(word: Column) -> Column:
        return F.when(F.lower(word).isin(rules.OLD_CONNECTIVES), F.lower(word)).otherwise(F.initcap(word))

    words = F.regexp_extract_all(col(name), F.lit(_WORDS_AND_GAPS), 1)
    return F.array_join(F.transform(words, word_form), "")


def display_name_with_proposal(name: ColumnLike, proposed: ColumnLike) -> Column:
    """A supplied name if it is the same name, else the rule-based one."""
    accepted = F.when(same_name(proposed, name), col(proposed))
    return pretty_quotes(F.coalesce(accepted, bind(display_name(name), display_name)))


def title_case(c: ColumnLike) -> Column:
    """Capital after every non-letter, as in ``Cluj-Napoca``."""
    runs = F.regexp_extract_all(col(c), F.lit(_LETTERS_AND_GAPS), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def county_from_text(c: ColumnLike) -> Column:
    """Code of the first listed county whose plain name occurs in the text."""

    def first_hit(text: Column) -> Column:
        return F.coalesce(*[F.when(text.contains(plain), code) for code, plain, _ in rules.COUNTIES])

    return bind(F.upper(plain_letters(c)), first_hit)
