"""Lists and tables that results must agree with."""

from __future__ import annotations

import unicodedata
from html.entities import html5, name2codepoint

# ---------------------------------------------------------------- fixed values

# Text decoded with the wrong code page, and what it stood for.
MOJIBAKE = [
    ("Ăˇ", "Á"),
    ("Ã¡", "Á"),
    ("Ă©", "É"),
    ("Ã©", "É"),
    ("Ĺ‘", "Ő"),
    ("Å‘", "Ő"),
    ("Ã¶", "Ö"),
    ("Ă¶", "Ö"),
    ("Ăł", "Ó"),
    ("Ã³", "Ó"),
    ("â€™", "'"),
    ("Â€™", "'"),
]

# Every way of writing a quote, brought to one sign. The order counts.
QUOTES = [
    ("’", "'"),
    ("‘", "'"),
    ("''", '"'),
    (",,", '"'),
    ("„", '"'),
    ("”", '"'),
    ("“", '"'),
    ('""', '"'),
    ("'", '"'),
]

# Cedilla letters and the comma-below letters that replace them.
CEDILLA, COMMA_BELOW = "ŞşŢţ", "ȘșȚț"

# Place words in canonical names. Substrings, in this order.
PLACES = [
    ("MUNICIPIUL", "MUN"),
    ("RAMNICU", "RM"),
    ("COMUNA", "COM"),
    ("LOCALITATEA GALATI", "MUN GALATI"),
    ("LOCALITATEA TECUCI", "MUN TECUCI"),
]

# Old spellings repaired before a display name is built.
OLD_SPELLINGS = [
    ("RIMNICU", "RÂMNICU"),
    ("RÎMNICU", "RÂMNICU"),
    ("TIRGU", "TÂRGU"),
    ("TÎRGU", "TÂRGU"),
    ("MUNICIPIUL", "MUN."),
]

# Words of a display name that keep this exact form.
KEPT_WORDS = [
    "de", "cu", "din", "von", "cel", "al", "la", "pe", "și", "sau",
    "II", "III", "IV", "UCECOM",
]

# Connectives of the older display-name rule.
OLD_CONNECTIVES = ["de", "cu", "din", "von", "cel", "al", "la", "pe", "si", "sau"]

# County code, plain name searched for in free text, display name. The order counts.
COUNTIES = [
    ("AB", "ALBA", "Alba"),
    ("AG", "ARGES", "Argeș"),
    ("AR", "ARAD", "Arad"),
    ("B", "BUCURESTI", "București"),
    ("BC", "BACAU", "Bacău"),
    ("BH", "BIHOR", "Bihor"),
    ("BN", "BISTRITA", "Bistrița-Năsăud"),
    ("BR", "BRAILA", "Brăila"),
    ("BT", "BOTOSANI", "Botoșani"),
    ("BV", "BRASOV", "Brașov"),
    ("BZ", "BUZAU", "Buzău"),
    ("CJ", "CLUJ", "Cluj"),
    ("CL", "CALARASI", "Călărași"),
    ("CS", "CARAS", "Caraș-Severin"),
    ("CT", "CONSTANTA", "Constanța"),
    ("CV", "COVASNA", "Covasna"),
    ("DB", "DAMBOVITA", "Dâmbovița"),
    ("DJ", "DOLJ", "Dolj"),
    ("GJ", "GORJ", "Gorj"),
    ("GL", "GALATI", "Galați"),
    ("GR", "GIURGIU", "Giurgiu"),
    ("HD", "HUNEDOARA", "Hunedoara"),
    ("HR", "HARGHITA", "Harghita"),
    ("IF", "ILFOV", "Ilfov"),
    ("IL", "IALOMITA", "Ialomița"),
    ("IS", "IASI", "Iași"),
    ("MH", "MEHEDINTI", "Mehedinți"),
    ("MM", "MARAMURES", "Maramureș"),
    ("MS", "MURES", "Mureș"),
    ("NT", "NEAMT", "Neamț"),
    ("OT", "OLT", "Olt"),
    ("PH", "PRAHOVA", "Prahova"),
    ("SB", "SIBIU", "Sibiu"),
    ("SJ", "SALAJ", "Sălaj"),
    ("SM", "SATU", "Satu Mare"),
    ("SV", "SUCEAVA", "Suceava"),
    ("TL", "TULCEA", "Tulcea"),
    ("TM", "TIMIS", "Timiș"),
    ("TR", "TELEORMAN", "Teleorman"),
    ("VL", "VALCEA", "Vâlcea"),
    ("VN", "VRANCEA", "Vrancea"),
    ("VS", "VASLUI", "Vaslui"),
]

# Exam result labels: accepted set, and synonyms that lead to it.
RESULT_LABELS = ["promovat", "nepromovat", "absent", "eliminat", "neevaluat"]
RESULT_SYNONYMS = {
    "reusit": "promovat",
    "respins": "nepromovat",
    "neprezentat": "absent",
    "eliminat din examen": "eliminat",
}
OLD_RESULT_SYNONYMS = {
    "ABSENT": "ABSENT",
    "NEPREZENTAT": "ABSENT",
    "RESPINS": "RESPINS",
    "NEPROMOVAT": "RESPINS",
    "ELIMINAT": "ELIMINAT",
    "ELIMINAT DIN EXAMEN": "ELIMINAT",
    "ADMIS": "REUSIT",
    "PROMOVAT": "REUSIT",
    "REUSIT": "REUSIT",
}

SEX_LABELS = {"masculin": "m", "feminin": "f", "m": "m", "f": "f"}

# Weights of the first nine digits of a school code; the tenth is the sum modulo nine.
SCHOOL_CODE_WEIGHTS = [2, 3, 5, 0, 7, 6, 1, 4, 8]

# Tiers of the edit-distance match, in tenths of the source key length.
HIGH_SCHOOL_TIERS = [1, 2, 3, 4]
MIDDLE_SCHOOL_TIERS = [0]

UNRANKED = 1_000_000
NO_STREET_NUMBER = ["", "-", ".", "x"]
REGISTRY_SCHOOL_TYPE = "Unitate de învățământ"
IMAGE_SUFFIXES = ["png", "ico", "jpg", "jpeg", "gif", "webp", "svg"]
ERROR_PAGE_MARK = "Eroare"
REQUIRED_FORM_FIELDS = ["__VIEWSTATE", "__VIEWSTATEGENERATOR", "__EVENTVALIDATION"]

# Letters without a canonical decomposition, and their plain spelling.
PLAIN_LETTERS = [
    ("ø", "o"), ("Ø", "O"), ("đ", "d"), ("Đ", "D"), ("ð", "d"), ("Ð", "D"),
    ("ł", "l"), ("Ł", "L"), ("ħ", "h"), ("Ħ", "H"), ("ı", "i"),
    ("ª", "a"), ("º", "o"), ("µ", "u"), ("×", "x"), ("¹", "1"), ("²", "2"), ("³", "3"),
]
PLAIN_LIGATURES = [
    ("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"),
    ("þ", "th"), ("Þ", "Th"), ("№", "No"), ("€", "EUR"), ("°", "deg"),
]

# Plain spelling of Greek and Cyrillic letters; capitals follow.
GREEK_LETTERS = [
    ("α", "a"), ("β", "b"), ("γ", "g"), ("δ", "d"), ("ε", "e"), ("ζ", "z"), ("η", "e"), ("θ", "th"), ("ι", "i"), ("κ", "k"),
    ("λ", "l"), ("μ", "m"), ("ν", "n"), ("ξ", "x"), ("ο", "o"), ("π", "p"), ("ρ", "r"), ("σ", "s"), ("ς", "s"), ("τ", "t"),
    ("υ", "u"), ("φ", "ph"), ("χ", "kh"), ("ψ", "ps"), ("ω", "o"),
]
CYRILLIC_LETTERS = [
    ("а", "a"), ("б", "b"), ("в", "v"), ("г", "g"), ("д", "d"), ("е", "e"), ("ж", "zh"), ("з", "z"), ("и", "i"), ("й", "i"),
    ("к", "k"), ("л", "l"), ("м", "m"), ("н", "n"), ("о", "o"), ("п", "p"), ("р", "r"), ("с", "s"), ("т", "t"), ("у", "u"),
    ("ф", "f"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "shch"), ("ъ", '"'), ("ы", "y"), ("ь", "'"),
    ("э", "e"), ("ю", "iu"), ("я", "ia"), ("ё", "io"), ("є", "ie"), ("і", "i"), ("ї", "yi"), ("ј", "j"), ("љ", "lj"), ("њ", "nj"),
    ("џ", "dzh"), ("ў", "u"), ("ґ", "g"),
]

# ------------------------------------------------------------- end fixed values

#: Alphabets whose letters are spelled by the first sound of their Unicode names.
_NAMED_LETTERS = [range(0x0531, 0x0587), range(0x05D0, 0x05EB), range(0x0621, 0x064B), range(0x10A0, 0x1100)]
_SOUNDS = ("SHCH", "DZH", "SH", "CH", "ZH", "TH", "KH", "GH", "PH", "DZ", "TS")
#: A letter of any script that has a plain spelling here.
OTHER_SCRIPTS = "[\u0370-\u03ff\u0400-\u0587\u05d0-\u05ea\u0621-\u064a\u10a0-\u10ff\u1f00-\u1fff]"


def script_table() -> tuple[tuple[str, str], list[tuple[str, str]]]:
    """Plain spelling of letters of other scripts: arguments for ``translate`` where it is one letter, and pairs
    to be replaced where it is several.

    Accented letters follow their base letter; capitals are spelled with one capital.
    """
    spelled = dict(GREEK_LETTERS + CYRILLIC_LETTERS)
    for block in _NAMED_LETTERS:
        for point in block:
            words = unicodedata.name(chr(point), "").split(" WITH ")[0].split()
            if "LETTER" in words and words[-1].isalpha():
                sound = next((s for s in _SOUNDS if words[-1].startswith(s)), words[-1][:1]).lower()
                spelled[chr(point)] = sound.capitalize() if "CAPITAL" in words else sound
    for letter, plain in GREEK_LETTERS + CYRILLIC_LETTERS:
        if letter.upper() not in spelled:
            spelled[letter.upper()] = plain.capitalize()
    for block in (range(0x0370, 0x0530), range(0x1F00, 0x2000)):
        for point in block:
            base = unicodedata.normalize("NFD", chr(point))[0]
            if base in spelled:
                spelled.setdefault(chr(point), spelled[base])
    single = {a: b for a, b in sorted(spelled.items()) if len(b) == 1}
    return ("".join(single), "".join(single.values())), [(a, b) for a, b in sorted(spelled.items()) if len(b) > 1]


def html_entities() -> dict[str, str]:
    """Named character references of HTML and their characters, from the standard table.

    A hard blank is a plain one here, as cells are trimmed and compared as text.
    """
    latin = {f"&{name}": text for name, text in html5.items() if name.endswith(";") and len(text) == 1 and text < "\u0250"}
    return latin | {f"&{name};": chr(point) for name, point in name2codepoint.items()} | {"&nbsp;": " "}


def accent_table() -> tuple[str, str]:
    """Arguments for ``translate``: Latin letters to ASCII, combining marks to nothing.

    Built from Unicode decompositions rather than listed.
    """
    source, target = [], []
    for block in (range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        for point in block:
            base = unicodedata.normalize("NFD", chr(point))[0]
            if base.isascii() and base.isalpha():
                source.append(chr(point))
                target.append(base)
    for letter, plain in PLAIN_LETTERS:
        source.append(letter)
        target.append(plain)
    marks = "".join(chr(point) for point in range(0x0300, 0x0370))
    return "".join(source) + marks, "".join(target)
