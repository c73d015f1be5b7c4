"""Text expressions: city keys, slugs, JSON validity, URL encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters a slug spells without their accent.
ACCENTED = {
    "a": "àáâãäå",
    "e": "èéêë",
    "i": "ìíîï",
    "o": "òóôõö",
    "u": "ùúûü",
    "n": "ñ",
    "c": "ç",
}


def uf_part(key: Column) -> Column:
    """State code of a ``UF-Name`` key, upper-cased."""
    return F.upper(F.get(F.split(key, "-"), F.lit(0)))


def city_part(key: Column, keep_tail: bool = False) -> Column:
    """City name of a ``UF-Name`` key; NULL when the key has no hyphen.

    By default the name ends at its own first hyphen; ``keep_tail`` keeps all
    of it.
    """
    return F.get(F.split(key, "-", 2 if keep_tail else -1), F.lit(1))


def slugify(text: Column) -> Column:
    """Lower-case ASCII letters, digits and single inner hyphens only."""
    accents = "".join(ACCENTED.values())
    plain = "".join(base * len(group) for base, group in ACCENTED.items())
    hyphened = F.translate(F.lower(text), " " + accents, "-" + plain)
    kept = F.regexp_replace(hyphened, "[^a-z0-9-]+", "")
    return F.btrim(F.regexp_replace(kept, "-{2,}", "-"), F.lit("-"))


def is_json(text: Column) -> Column:
    """Whether the text is one JSON value; scalars and ``null`` count.

    The parser stops after the first value, so the text is tried inside an array
    and inside an object: anything after the value breaks one of the two.  Strict
    JSON: NaN, Infinity and repeated keys are invalid.
    """
    in_array = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    valid = F.try_parse_json(in_array).isNotNull() & F.try_parse_json(in_object).isNotNull()
    return F.coalesce(valid, F.lit(False))


def url_encode(text: Column) -> Column:
    """Percent-encode for a URL path: ``/`` and ``~`` stay, a space is %20."""
    encoded = F.url_encode(text)
    for form, path_form in {"+": "%20", "*": "%2A", "%7E": "~", "%2F": "/"}.items():
        encoded = F.replace(encoded, F.lit(form), F.lit(path_form))
    return encoded
