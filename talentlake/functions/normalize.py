"""Listing normalisers as pure column expressions (no Python UDFs).

Each function takes raw text column(s) and returns Column(s); none runs an
action. They are composed into the silver table by
``talentlake.operators.silver``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.functions.rules import RuleSet
from talentlake.functions.text import contains_any, ilike_any, java_regex, py_strip, py_title


# Stands for a pay number that does not fit 64 bits.
BEYOND_ANY_PAY = "9" * 18


# ---------------------------------------------------------------- N1 title
def title_key(title: Column) -> Column:
    """Text the title rules are searched in."""
    return F.lower(F.coalesce(title, F.lit("")))


def profile_of(title_text: Column, rules=L.TITLE_RULES, default=L.TITLE_DEFAULT) -> Column:
    """Rules over a prepared title text; every rule is tried, the last match wins."""
    return RuleSet(rules, policy="last", default=default).label(title_text)


def title_profile(title: Column, rules=L.TITLE_RULES, default=L.TITLE_DEFAULT) -> Column:
    """Job title -> profile."""
    return profile_of(title_key(title), rules, default)


# ---------------------------------------------------------------- N2-N5 pay
# The pay parser is split into steps over prepared columns; ``to_silver``
# projects each step once (a multiply-used regex result is never inlined
# twice), ``pay_struct`` chains them for standalone use.
def pay_is_sentinel(pay: Column, sentinels=L.PAY_SENTINELS) -> Column:
    """NULL, or an exact (lower-cased, untrimmed) match of a sentinel word."""
    return pay.isNull() | F.lower(pay).isin(list(sentinels))


def pay_key(pay: Column) -> Column:
    """Lower-cased, spaces and U+202F removed, ``,`` -> ``.``."""
    s = F.lower(pay)
    for token in L.PAY_DELETE_FIRST:
        s = F.replace(s, F.lit(token), F.lit(""))
    return F.replace(s, F.lit(","), F.lit("."))


def pay_is_eur(key: Column) -> Column:
    return contains_any(key, L.PAY_CURRENCY_MARKERS_EUR)


def pay_strip_units(key: Column) -> Column:
    s = key
    for token in L.PAY_UNIT_TOKENS:
        s = F.replace(s, F.lit(token), F.lit(""))
    return s


def pay_expand_k(text: Column) -> Column:
    """Every ``<number>k`` replaced in place by ``int(number * 1000)``: the
    pieces between K-numbers interleaved with the expanded numbers (same
    left-to-right match sequence as a regex substitution). A product beyond
    64 bits becomes a number above every plausible pay, so that the row is
    rejected as implausible instead of failing the job."""
    pieces = F.split(text, L.PAY_K_PATTERN, -1)
    knums = F.regexp_extract_all(text, F.lit(L.PAY_K_PATTERN), F.lit(1))

    def thousands(number: Column) -> Column:
        product = (number.cast("double") * F.lit(1000.0)).try_cast("bigint").cast("string")
        return F.when(number.isNull(), F.lit("")).otherwise(F.coalesce(product, F.lit(BEYOND_ANY_PAY)))

    expanded = F.array_join(
        F.transform(pieces, lambda piece, i: F.concat(piece, thousands(F.try_element_at(knums, i + 1)))), "")
    # without a "k" the pattern cannot match and the text is unchanged
    return F.when(F.contains(text, F.lit("k")), expanded).otherwise(text)


def pay_numbers(expanded: Column, is_eur: Column, eur_rate: float = L.EUR_TO_MAD) -> Column:
    """struct(n, lo, hi): how many of the first two numbers exist (0-2) and
    their min / max in MAD (``least``/``greatest`` skip a missing second)."""
    found = F.regexp_extract_all(expanded, F.lit(L.PAY_NUMBER_PATTERN), F.lit(0))

    def mad(i: int) -> Column:
        v = F.try_element_at(found, F.lit(i)).cast("double")
        return F.when(is_eur, v * F.lit(eur_rate)).otherwise(v)

    a, b = mad(1), mad(2)
    return F.struct(
        F.least(F.size(found), F.lit(2)).alias("n"),
        F.least(a, b).alias("lo"),
        F.greatest(a, b).alias("hi"),
    )


def pay_known(numbers: Column, is_sentinel: Column, low: float = L.PAY_MIN_PLAUSIBLE,
              high: float = L.PAY_MAX_PLAUSIBLE) -> Column:
    known = ((~is_sentinel) & (numbers["n"] > 0)
             & (numbers["lo"] >= F.lit(low)) & (numbers["hi"] <= F.lit(high)))
    return F.coalesce(known, F.lit(False))


def pay_struct(pay: Column, eur_rate: float = L.EUR_TO_MAD, low: float = L.PAY_MIN_PLAUSIBLE,
               high: float = L.PAY_MAX_PLAUSIBLE) -> Column:
    """Pay text -> struct(min, max, known) in MAD (standalone form)."""
    key = pay_key(pay)
    numbers = pay_numbers(pay_expand_k(pay_strip_units(key)), pay_is_eur(key), eur_rate)
    known = pay_known(numbers, pay_is_sentinel(pay), low, high)
    return F.struct(
        F.when(known, numbers["lo"]).alias("salaire_min_mad"),
        F.when(known, numbers["hi"]).alias("salaire_max_mad"),
        known.alias("salaire_connu"),
    )


# ---------------------------------------------------------------- N6 experience
def experience_key(exp: Column) -> Column:
    return F.lower(py_strip(exp))


def experience_bounds(key: Column) -> Column:
    """Prepared experience text -> struct(min years, max years); keyword
    tests first, then ``a-b`` ranges, then ``n+ / n ans / n years``."""
    # Unicode white space (U+00A0, U+202F, ...) separates numbers too
    span, single = java_regex(L.EXPERIENCE_RANGE), java_regex(L.EXPERIENCE_MIN_ONLY)
    rng1 = F.regexp_extract(key, span, 1)
    rng2 = F.regexp_extract(key, span, 2)
    one = F.regexp_extract(key, single, 1)
    # group 1 is ``\d+``: non-empty exactly when the pattern matches, so no
    # separate ``rlike`` pass is needed
    has_rng = rng1 != F.lit("")
    has_one = one != F.lit("")
    lo = F.when(key.isNull(), F.lit(None).cast("int"))
    hi = F.when(key.isNull(), F.lit(None).cast("int"))
    for needles, kmin, kmax in L.EXPERIENCE_KEYWORDS:
        cond = contains_any(key, needles)
        lo = lo.when(cond, F.lit(kmin))
        hi = hi.when(cond, F.lit(kmax).cast("int"))
    lo = lo.when(has_rng, rng1.try_cast("int")).when(has_one, one.try_cast("int"))
    hi = hi.when(has_rng, rng2.try_cast("int")).when(has_one, F.lit(None).cast("int"))
    return F.struct(lo.cast("int").alias("experience_min_ans"), hi.cast("int").alias("experience_max_ans"))


def experience_struct(exp: Column) -> Column:
    return experience_bounds(experience_key(exp))


# ---------------------------------------------------------------- N7-N8 city
def city_match(city_lower: Column, rules=L.CITY_RULES) -> Column:
    """Canonical city of the first matching rule, else NULL."""
    return RuleSet(rules, policy="first", default=None, ignore_case=True).label(city_lower)


def city_region(city: Column, stripped: Column, matched: Column, regions=L.REGIONS,
                unknown=L.CITY_UNKNOWN) -> Column:
    """struct(canonical city, region) from the raw text, its stripped form and
    the rule match; an unrecognised name is kept, title-cased, region unknown."""
    empty = city.isNull() | (city == F.lit(""))
    ville = F.when(empty, F.lit(unknown)).otherwise(F.coalesce(matched, py_title(stripped)))
    region_map = F.create_map(*[F.lit(x) for kv in regions.items() for x in kv])
    region = F.when(empty | matched.isNull(), F.lit(unknown)).otherwise(
        F.coalesce(F.try_element_at(region_map, matched), F.lit(unknown))
    )
    return F.struct(ville.alias("ville_std"), region.alias("region_admin"))


def city_struct(city: Column, rules=L.CITY_RULES, regions=L.REGIONS, unknown=L.CITY_UNKNOWN) -> Column:
    """City text -> struct(canonical city, region) (standalone form)."""
    stripped = py_strip(city)
    return city_region(city, stripped, city_match(F.lower(stripped), rules), regions, unknown)


# ---------------------------------------------------------------- N9 contract
def contract_type(contract: Column, rules=L.CONTRACT_RULES, default=L.CONTRACT_DEFAULT) -> Column:
    """Contract text -> one of CDI / CDD / Freelance / Stage / Alternance."""
    s = F.lower(contract)   # substring tests: outer whitespace cannot change a hit
    expr = F.when(contract.isNull() | (contract == F.lit("")), F.lit(default))
    for needles, label in rules:
        expr = expr.when(contains_any(s, needles), F.lit(label))
    return expr.otherwise(F.lit(default))


# ---------------------------------------------------------------- N10-N11 dates
def parse_day(text: Column) -> Column:
    """First 10 characters as ``Y-M-D`` (four-digit year, zero padding of month and
    day optional) -> DATE, else NULL."""
    day = F.substring(text, 1, 10)
    return F.when(day.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.to_date(F.try_to_timestamp(day, F.lit("y-M-d"))))


# ---------------------------------------------------------------- N12
def text_or_list(text: Column) -> Column:
    """A field that is a JSON array of texts or one plain text -> array of texts
    (of the one plain text, so that ``join_list`` gives it back)."""
    parsed = F.from_json(text, "array<string>")
    return F.when(F.ltrim(text).startswith("["), parsed).otherwise(F.when(text.isNotNull(), F.array(text)))


def join_list(col: Column, sep: str = ", ") -> Column:
    """Array of strings -> ``sep``-joined text; NULL -> empty text."""
    return F.coalesce(F.array_join(col, sep), F.lit(""))


# ---------------------------------------------------------------- N13, N14, N20
def experience_band(years: Column, bands=L.EXPERIENCE_BANDS, unknown=L.EXPERIENCE_BAND_UNKNOWN) -> Column:
    """Minimum years -> band label (0 / 1-2 / 3-4 / 5-7 / 8+)."""
    b0, b1, b2, b3, b4 = bands
    return (
        F.when(years == 0, F.lit(b0))
        .when(years.between(1, 2), F.lit(b1))
        .when(years.between(3, 4), F.lit(b2))
        .when(years.between(5, 7), F.lit(b3))
        .when(years >= 8, F.lit(b4))
        .otherwise(F.lit(unknown))
    )


def competition_level(mean_pay: Column, levels=L.COMPETITION_LEVELS, default=L.COMPETITION_DEFAULT) -> Column:
    expr = None
    for threshold, label in levels:
        cond = mean_pay > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def is_remote(text: Column, keywords=L.REMOTE_KEYWORDS) -> Column:
    """Remote/hybrid predicate: case-blind substring of any keyword; NULL -> false."""
    return F.coalesce(ilike_any(text, keywords), F.lit(False))


def experience_band_index(band: Column, bands=L.EXPERIENCE_BANDS) -> Column:
    """Ordinal code of a band label (1-based; 0 when unknown)."""
    return F.array_position(F.array(*[F.lit(b) for b in bands]), band)
