"""Names, identifiers, values and other text clean-up."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from freshet.functions.risk import lookup

TRUE_WORDS = ["true", "t", "yes", "y", "1", "1.0"]
FALSE_WORDS = ["false", "f", "no", "n", "0", "0.0"]


def _folding(first: int, last: int) -> tuple[str, str]:
    """Characters in a code range that decompose to one ASCII letter, with that letter."""
    source, target = [], []
    for code in range(first, last + 1):
        base = [c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0].isascii() and base[0].isalpha() and chr(code) not in base:
            source.append(chr(code))
            target.append(base[0].lower())
    return "".join(source), "".join(target)


# The accented letters folded in the place-name key, by plain letter.
ACCENTED = {"a": "àáâäãå", "e": "èéêë", "i": "ìíîï", "o": "òóôöõ", "u": "ùúûü", "y": "ýÿŷ", "c": "ç", "n": "ñ", "w": "ŵ"}
LATIN = ("".join(ACCENTED.values()), "".join(plain * len(marked) for plain, marked in ACCENTED.items()))
# The general key folds every Latin letter that decomposes to a plain one.
LATIN_WIDE = _folding(0x00C0, 0x1EFF)


def _name_key(name: Column, table: tuple[str, str]) -> Column:
    folded = F.translate(F.lower(name), *table)
    return F.regexp_replace(F.replace(folded, F.lit("&"), F.lit("and")), "[^a-z0-9]", "")


def name_key(name: Column) -> Column:
    """Place-name match key: lower case, accents folded, "&" as "and", letters and digits only."""
    return _name_key(name, LATIN)


def general_name_key(name: Column) -> Column:
    """As ``name_key``, with stand-alone combining marks dropped and the wide Latin ranges folded."""
    return _name_key(F.regexp_replace(name, r"\p{M}+", ""), LATIN_WIDE)


def clean(value: Column) -> Column:
    """Trimmed text; blanks and the words nan, none and null are NULL; ``4687.0`` loses its ``.0``."""
    text = F.trim(value.cast("string"))
    blank = (text == "") | F.lower(text).isin("nan", "none", "null")
    return F.when(~blank, F.regexp_replace(text, r"^(\d+)\.0+$", "$1"))


def id_key(value: Column) -> Column:
    """Upper-case identifier; leading zeros go from prefix-digits-suffix identifiers."""
    text = clean(value)
    shape = r"^([A-Za-z]*)0*(\d+)([A-Za-z]*)$"
    part = lambda i: F.regexp_extract(text, shape, i)
    return F.when(text.rlike(shape), F.upper(F.concat(part(1), part(2), part(3)))).otherwise(F.upper(text))


def tidy_id(value: Column) -> Column:
    text = F.regexp_replace(F.upper(clean(value)), r"[\s\-_]", "")
    trimmed = F.regexp_replace(text, "^0+", "")
    return F.when(trimmed == "", "0").otherwise(trimmed)


def id_shape(value: Column) -> Column:
    """Digits as 9, letters as A, the rest kept."""
    text = F.coalesce(clean(value), F.lit(""))
    return F.regexp_replace(F.regexp_replace(text, r"\p{L}", "A"), r"\p{Nd}", "9")


def underscore_tg(value: Column) -> Column:
    """``067033_TG 148`` written with the underscore."""
    return F.regexp_replace(value, r"(?i)(_TG)\s+(\d+)$", "$1_$2")


def pad_six(value: Column) -> Column:
    """Digits shorter than six get their leading zeros back."""
    return F.when(value.rlike(r"^\d{1,5}$"), F.lpad(value, 6, "0")).otherwise(value)


def is_scientific(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^\d+(\.\d+)?[eE][+-]?\d+$"), F.lit(False))


def truth(value: Column) -> Column:
    """TRUE / FALSE for the usual words, NULL for anything else."""
    word = F.lower(clean(value))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def unit_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(clean(text)), "[^a-z0-9]", "")


def postcode(text: Column) -> Column:
    joined = F.regexp_replace(F.upper(text), r"\s+", "")
    return F.when(joined.isNull() | joined.isin("NONE", "NAN"), "").otherwise(joined)


def station_key(uri: Column) -> Column:
    """A station URI without scheme or trailing slash, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(uri, "^https?://", ""), "/+$", ""))


def uri_tail(uri: Column) -> Column:
    return F.coalesce(F.substring_index(F.regexp_replace(uri, "/+$", ""), "/", -1), F.lit(""))


def reading_value(raw: Column) -> Column:
    """The first value of a reading text; lists and ``a|b`` pairs keep their first part, non-numbers are NULL."""
    text = F.trim(raw.cast("string"))
    first = F.when(text.startswith("["), F.get_json_object(text, "$[0]")).otherwise(text)
    number = F.trim(F.split(first, r"\|")[0]).try_cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    is_flag = F.lower(text).isin("true", "false")
    return F.when(finite & ~F.coalesce(is_flag, F.lit(False)), number)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def whole_number_text(value: Column) -> Column:
    """Numbers at the table edge: whole values print without a decimal part, missing ones are NULL."""
    number = nan_to_null(value.cast("double"))
    return F.when(number == F.floor(number), number.cast("long").cast("string")).otherwise(number.cast("string"))


# Keyword to measured family, first hit wins; code prefix to family.
TEXT_FAMILIES = [
    ("groundwater", "groundwater"), ("wave", "wave"), ("shingle", "shingle"), ("gate", "gate"), ("wind", "wind"),
    ("rain", "rainfall"), ("flow", "flow"), ("level", "level"), ("stage", "level"),
]
CODE_FAMILIES = {
    "h": "level", "q": "flow", "p": "rainfall", "gw": "groundwater", "wave": "wave", "shingle": "shingle",
    "gate": "gate", "wind": "wind",
}


def text_family(text: Column) -> Column:
    lowered = F.lower(clean(text))
    return F.coalesce(*[F.when(lowered.contains(word), family) for word, family in TEXT_FAMILIES])


def code_family(code: Column) -> Column:
    return lookup(F.substring_index(F.lower(clean(code)), ".", 1), CODE_FAMILIES)


def family_conflict(from_text: Column, from_code: Column) -> Column:
    """Both named, different, and not the level text of a groundwater code."""
    borehole = (from_text == "level") & (from_code == "groundwater")
    return F.coalesce((from_text != from_code) & ~borehole, F.lit(False))


def reconciled_family(from_text: Column, from_code: Column) -> Column:
    borehole = (from_text == "level") & (from_code == "groundwater")
    return (F.when(borehole, "groundwater")
            .when(~family_conflict(from_text, from_code), F.coalesce(from_text, from_code)))


# Filler words of gauge names, and Welsh place-name elements.
FILLER_WORDS = [
    "the", "at", "rg", "gauge", "raingauge", "rain", "rainfall", "station", "level", "river", "road", "rd", "stw", "wtw",
    "inactive", "gl", "gwl", "obs", "bridge", "br", "fb", "weir",
]
WELSH_STARTS = [
    "aber", "afon", "bryn", "caer", "coed", "glan", "llan", "llyn", "maes", "nant", "pont", "porth", "rhyd", "rhos",
    "ystrad", "pwll", "cefn",
]
WELSH_WORDS = ["pen", "ty", "tre", "dol", "cwm", "bach", "fach", "mawr"]


def name_tokens(name: Column) -> Column:
    """Sorted distinct words of a name, filler words and single characters left out."""
    words = F.regexp_extract_all(F.lower(F.coalesce(clean(name), F.lit(""))), F.lit("([a-z0-9]+)"), 1)
    useful = F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(FILLER_WORDS))
    return F.array_sort(F.array_distinct(useful))


def token_overlap(a: Column, b: Column) -> Column:
    """Jaccard share of two token arrays, 0 when either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def name_similarity(a: Column, b: Column) -> Column:
    """The better of word overlap and edit similarity (1 - edits / length) of the sorted words, 3 decimals; 0 when either is empty."""
    left, right = F.concat_ws(" ", a), F.concat_ws(" ", b)
    edits = 1 - F.levenshtein(left, right) / F.greatest(F.length(left), F.length(right))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.round(F.greatest(token_overlap(a, b), edits), 3)).otherwise(0.0)


def welsh_hint(name: Column) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(clean(name), F.lit(""))), F.lit("([a-z]+)"), 1)
    starts = "^(" + "|".join(WELSH_STARTS) + ")"
    return F.exists(words, lambda w: w.isin(WELSH_WORDS) | w.rlike(starts))


def guidance_present(status: Column) -> Column:
    text = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    return ~text.startswith("no ") & text.contains("present")


def guidance_key(update_id: Column, last_updated: Column) -> Column:
    missing = F.concat(F.lit("none_"), F.coalesce(last_updated, F.lit("unknown")))
    return F.coalesce(update_id.cast("long").cast("string"), missing)


def polygon_key(key: Column, number: Column) -> Column:
    return F.concat_ws("|", key, number.cast("long").cast("string"))


def url_event_id(*parts: Column) -> Column:
    """Version 5 identifier of ``parts`` joined by "|" in the URL namespace, from SHA-1 and string slicing.

    Missing parts read ``None``; times must be passed as one canonical text.
    """
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    namespace = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))
    digest = F.sha1(F.concat(namespace, F.encode(key, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12))


def iso_utc(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ssXXX")


def any_time(text: Column, formats: list[str]) -> Column:
    """The first of several layouts that reads the text."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])
