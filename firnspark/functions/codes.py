"""Name-to-code lookups and identifier strings."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, functions as F

# Numeric codes of the published names.
RISK_CODES = {
    "NOFORECAST": 0,
    "LOW": 1,
    "MODERATE": 2,
    "CONSIDERABLE": 3,
    "HIGH": 4,
    "EXTREME": 5,
}
PROBLEM_CODES = {
    "NOFORECAST": 0,
    "LOOSEDRY": 1,
    "STORMSLAB": 2,
    "WINDSLAB": 3,
    "PERSISTENTSLAB": 4,
    "DEEPPERSISTENTSLAB": 5,
    "WETLOOSE": 6,
    "WETSLAB": 7,
    "CORNICE": 8,
    "GLIDE": 9,
}
LIKELIHOOD_CODES = {
    "NOFORECAST": 0,
    "UNLIKELY": 1,
    "POSSIBLE": 2,
    "LIKELY": 3,
    "VERYLIKELY": 4,
    "ALMOSTCERTAIN": 5,
}
PROBLEM_CLASSES = list(range(10))

# Words of the spelled-out aspect and elevation phrases, applied in this order.
PHRASE_WORDS = [
    ("north", "n"),
    ("northeast", "ne"),
    ("east", "e"),
    ("southeast", "se"),
    ("south", "s"),
    ("southwest", "sw"),
    ("west", "w"),
    ("northwest", "nw"),
    ("upper", "alp"),
    ("middle", "tln"),
    ("lower", "btl"),
]

# Zone name to the area id first posted for it.
NWAC_AREA_IDS = {
    "Olympics": 1128,
    "West Slopes North": 1129,
    "West Slopes Central": 1130,
    "West Slopes South": 1131,
    "Stevens Pass": 1132,
    "Snoqualmie Pass": 1136,
    "East Slopes North": 1137,
    "East Slopes Central": 1138,
    "East Slopes South": 1139,
    "Mt Hood": 1140,
}
NWAC_REGIONS = [f"NWAC.{area}" for area in NWAC_AREA_IDS.values()]

ASPECT_MODELS = [
    f"aspect_{component}_{elevation}_{slot}"
    for component, elevation, slot in product(("sin", "cos", "range"), ("alp", "tln", "btl"), range(3))
]
PROBLEM_MODELS = [f"problem_type_{slot}" for slot in range(3)]
# Deployed release of every model.
DEPLOYMENTS = {name: "v000" for name in PROBLEM_MODELS} | {name: "v001" for name in ASPECT_MODELS}


def literal_lookup(table: dict, key: Column) -> Column:
    """Value of ``key`` in a small constant table, null when absent."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def place_among(names: list[str], name: Column) -> Column:
    """Place of a name in a list from 1 on, 0 when absent: one search, in lambdas far cheaper than a map's keys."""
    if any("," in own or not own for own in names):
        raise ValueError("listed names are not empty and have no comma")
    return F.find_in_set(name, F.lit(",".join(names)))


def listed_code(table: dict[str, int], name: Column) -> Column:
    """``literal_lookup`` in a table whose values count up from 0."""
    if list(table.values()) != list(range(len(table))):
        raise ValueError("codes count up from 0")
    place = place_among(list(table), name)
    return (F.nullif(place, F.lit(0)) - 1).cast("long")


def risk_code(name: Column) -> Column:
    """Lenient: unknown, empty and missing names mean no forecast."""
    found = listed_code(RISK_CODES, F.upper(name))
    return F.coalesce(found, F.lit(0)).cast("long")


def problem_code(name: Column) -> Column:
    """Strict: null for an unknown name."""
    spelled = F.replace(F.upper(name), F.lit("DRYLOOSE"), F.lit("LOOSEDRY"))
    return listed_code(PROBLEM_CODES, spelled)


def likelihood_code_ranged(name: Column) -> Column:
    """Strict code of ``low_high`` style names: the first part counts."""
    first = F.upper(F.substring_index(name, "_", 1))
    spelled = F.when(first == "CERTAIN", "ALMOSTCERTAIN").otherwise(first)
    return listed_code(LIKELIHOOD_CODES, spelled)


def likelihood_code_spaced(name: Column) -> Column:
    """Strict code of names written as words."""
    spelled = F.upper(F.replace(name, F.lit(" "), F.lit("")))
    return listed_code(LIKELIHOOD_CODES, spelled)


def _shorten(phrase: str) -> str:
    for word, short in PHRASE_WORDS:
        phrase = phrase.replace(word, short)
    return phrase.replace(" ", "_")


# The 24 regular phrases; anything else is shortened word by word at run time.
KNOWN_PHRASES = {
    f"{aspect} {elevation}": _shorten(f"{aspect} {elevation}")
    for (aspect, _), (elevation, _) in product(PHRASE_WORDS[:8], PHRASE_WORDS[8:])
}


def phrase_to_flag(phrase: Column) -> Column:
    """``northeast upper`` -> ``ne_alp``; other words pass through."""
    shortened = reduce(lambda text, word: F.replace(text, F.lit(word[0]), F.lit(word[1])), PHRASE_WORDS, phrase)
    spelled_out = F.replace(shortened, F.lit(" "), F.lit("_"))
    known = F.get(F.lit(list(KNOWN_PHRASES.values())), place_among(list(KNOWN_PHRASES), phrase) - 1)
    return F.coalesce(known, spelled_out)


def region_key(center: str | Column, area_id: Column) -> Column:
    head = F.lit(center) if isinstance(center, str) else center
    return F.concat(head, F.lit("."), area_id.cast("string"))


def area_of_zone(zone_name: Column, posted_id: Column) -> Column:
    return F.coalesce(literal_lookup(NWAC_AREA_IDS, zone_name).cast("string"), posted_id.cast("string"))


def first_text(*texts: Column) -> Column:
    """First text that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(text, F.lit("")) for text in texts], F.lit(""))


def run_key(day: Column, region_id: Column) -> Column:
    return F.concat_ws("|", F.date_format(day, "yyyy-MM-dd"), region_id)


def model_id(name: Column, season: Column, region_id: Column) -> Column:
    return F.replace(F.concat_ws(".", name, season, region_id), F.lit("/"), F.lit("-"))


def deployment_alias(release: Column) -> Column:
    return F.concat(release, F.lit("-deployment"))


def model_slot(name: str) -> int:
    """Problem slot of an aspect model name; unknown names are an error."""
    if name not in ASPECT_MODELS:
        raise ValueError(f"unknown aspect model {name!r}")
    return int(name.rsplit("_", 1)[1])


def deployed_release(name: str) -> str:
    try:
        return DEPLOYMENTS[name]
    except KeyError:
        raise ValueError(f"no deployment is configured for model {name!r}") from None
