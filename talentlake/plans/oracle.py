"""Independent SQL oracle (DuckDB dialect) for every registered query.

Each query's oracle is one SQL text over the shared test tables: the
listing view, a silver CTE written with DuckDB's own functions (RE2
regexes, list lambdas), a skills CTE (theta join on regex) and the gold /
analysis SELECTs. It shares only the fixed lexicons with the Spark code,
not any expression builder, so it checks the Spark plans' semantics.
"""

from __future__ import annotations

from talentlake import lexicons as L
from talentlake.sources.listings import LISTINGS_VIEW_SQL, VIEW_TO_RAW
from talentlake.operators.skills import load_dictionary

WORD = r"[\p{L}\p{N}_]"
NONWORD = r"[^\p{L}\p{N}_]"


# White space as Python has it, spelled out for RE2, whose \\s is ASCII.
SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def re2(py_pattern: str) -> str:
    """Python pattern -> RE2: ``\\w`` as a Unicode class; a trailing ``\\b``
    (always after a word character in the lexicons) as 'non-word or end'."""
    return py_pattern.replace(r"\w", WORD).replace(r"\b", f"({NONWORD}|$)")


def escape(text: str) -> str:
    return "".join("\\" + c if c in set(".^$*+?()[]{}|\\-/") else c for c in text)


def lst(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _contains_any(col: str, needles) -> str:
    return "(" + " OR ".join(f"contains({col}, {q(n)})" for n in needles) + ")"


def _title_case(col: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({col}, '\\p{{L}}+|[^\\p{{L}}]+'), "
            f"lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '')")


def _py_strip(col: str) -> str:
    return f"regexp_replace({col}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def rhu(expr: str, digits: int = 0) -> str:
    """Half-up rounding to a DOUBLE, same formula as the Spark side."""
    scale = float(10 ** digits)
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + 0.5) / {scale})"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return rhu(f"CAST({part} AS DOUBLE) * 100.0 / nullif(CAST({whole} AS DOUBLE), 0.0)", digits)


# ------------------------------------------------------------------ CTEs
def raw_cte() -> str:
    view = LISTINGS_VIEW_SQL.replace("{orders}", "orders")
    cols = ",\n    ".join(f"{v} AS {r}" for v, r in VIEW_TO_RAW.items())
    return (f"fixture_view AS ({view}),\n"
            f"raw AS (SELECT\n    {cols},\n    CASE WHEN starts_with(languages_text, '[') THEN CAST(CAST(languages_text AS JSON) AS VARCHAR[])\n"
            f"         WHEN languages_text IS NOT NULL THEN [languages_text] END AS langue_requise\n  FROM fixture_view)")


def _title_case_sql() -> str:
    whens = "\n      ".join(
        f"WHEN regexp_matches(_t, {q(re2(p))}) THEN {q(label)}" for p, label in reversed(L.TITLE_RULES)
    )
    return f"CASE\n      {whens}\n      ELSE {q(L.TITLE_DEFAULT)} END"


def _city_sql() -> str:
    whens = "\n      ".join(f"WHEN regexp_matches(_c, {q(re2(p))}) THEN {q(label)}" for p, label in L.CITY_RULES)
    return f"CASE\n      {whens}\n      ELSE NULL END"


def _region_sql(col: str) -> str:
    whens = " ".join(f"WHEN {q(c)} THEN {q(r)}" for c, r in L.REGIONS.items())
    return f"CASE {col} {whens} ELSE {q(L.CITY_UNKNOWN)} END"


def _contract_sql() -> str:
    whens = "\n      ".join(f"WHEN {_contains_any('_k', needles)} THEN {q(label)}" for needles, label in L.CONTRACT_RULES)
    return (f"CASE WHEN type_contrat IS NULL OR type_contrat = '' THEN {q(L.CONTRACT_DEFAULT)}\n      {whens}\n"
            f"      ELSE {q(L.CONTRACT_DEFAULT)} END")


def _experience_sql(which: int) -> str:
    parts = []
    for needles, kmin, kmax in L.EXPERIENCE_KEYWORDS:
        val = kmin if which == 1 else kmax
        parts.append(f"WHEN {_contains_any('_e', needles)} THEN {'NULL' if val is None else val}")
    rng = q(L.EXPERIENCE_RANGE.replace(r"\s", SPACE))
    one = q(L.EXPERIENCE_MIN_ONLY.replace(r"\s", SPACE))
    if which == 1:
        parts.append(f"WHEN regexp_matches(_e, {rng}) THEN TRY_CAST(regexp_extract(_e, {rng}, 1) AS INTEGER)")
        parts.append(f"WHEN regexp_matches(_e, {one}) THEN TRY_CAST(regexp_extract(_e, {one}, 1) AS INTEGER)")
    else:
        parts.append(f"WHEN regexp_matches(_e, {rng}) THEN TRY_CAST(regexp_extract(_e, {rng}, 2) AS INTEGER)")
    body = "\n      ".join(parts)
    return f"CAST(CASE WHEN _e IS NULL THEN NULL\n      {body}\n      ELSE NULL END AS INTEGER)"


def _day_sql(col: str) -> str:
    """A four-digit year, then month and day of one or two digits, cut apart and put together."""
    part = [f"try_cast(regexp_extract(substring({col}, 1, 10), '^([0-9]{{4}})-([0-9]{{1,2}})-([0-9]{{1,2}})$', {i}) AS INTEGER)" for i in (1, 2, 3)]
    return f"try_cast(printf('%04d-%02d-%02d', {part[0]}, {part[1]}, {part[2]}) AS DATE)"


def silver_cte() -> str:
    sentinels = lst(L.PAY_SENTINELS)
    eur = _contains_any("_p1", L.PAY_CURRENCY_MARKERS_EUR)
    p2 = "_p1"
    for tok in L.PAY_UNIT_TOKENS:
        p2 = f"replace({p2}, {q(tok)}, '')"
    kpat = q(L.PAY_K_PATTERN)
    npat = q(L.PAY_NUMBER_PATTERN)
    return f"""s1 AS (
  SELECT *,
    lower(coalesce(titre_poste, '')) AS _t,
    replace(replace(replace(lower(salaire_brut), ' ', ''), chr(8239), ''), ',', '.') AS _p1,
    (salaire_brut IS NULL OR lower(salaire_brut) IN {sentinels}) AS _psent,
    lower({_py_strip('experience_requise')}) AS _e,
    lower({_py_strip('ville')}) AS _c,
    {_py_strip('ville')} AS _cs,
    lower(type_contrat) AS _k,
    {_day_sql('date_publication')} AS _dp,
    {_day_sql('date_expiration')} AS _de
  FROM raw
),
s2 AS (
  SELECT *, {eur} AS _eur, {p2} AS _p2 FROM s1
),
s3 AS (
  SELECT *,
    array_to_string(list_transform(string_split_regex(_p2, {kpat}),
      lambda piece, i: piece || CASE WHEN i > len(regexp_extract_all(_p2, {kpat}, 1)) THEN '' ELSE
        CAST(CAST(least(trunc(CAST(regexp_extract_all(_p2, {kpat}, 1)[i] AS DOUBLE) * 1000.0), 1e18) AS HUGEINT) AS VARCHAR) END), '') AS _p3
  FROM s2
),
s4 AS (
  SELECT *,
    list_transform(regexp_extract_all(_p3, {npat})[1:2],
      lambda n: CASE WHEN _eur THEN CAST(n AS DOUBLE) * {L.EUR_TO_MAD} ELSE CAST(n AS DOUBLE) END) AS _nums
  FROM s3
),
s5 AS (
  SELECT *,
    coalesce(NOT _psent AND len(_nums) > 0 AND list_min(_nums) >= {L.PAY_MIN_PLAUSIBLE}
             AND list_max(_nums) <= {L.PAY_MAX_PLAUSIBLE}, false) AS _known,
    {_city_sql()} AS _cm
  FROM s4
),
silver AS (
  SELECT
    id_offre, source, titre_poste, description, competences_brut, entreprise, ville, type_contrat,
    experience_requise, salaire_brut, niveau_etudes, secteur, date_publication, date_expiration,
    nb_postes, teletravail, langue_requise,
    {_title_case_sql()} AS profil_normalise,
    CASE WHEN _known THEN list_min(_nums) END AS salaire_min_mad,
    CASE WHEN _known THEN list_max(_nums) END AS salaire_max_mad,
    _known AS salaire_connu,
    (CASE WHEN _known THEN list_min(_nums) END + CASE WHEN _known THEN list_max(_nums) END) / 2.0 AS salaire_median_mad,
    {_experience_sql(1)} AS experience_min_ans,
    {_experience_sql(2)} AS experience_max_ans,
    CASE WHEN ville IS NULL OR ville = '' THEN {q(L.CITY_UNKNOWN)} ELSE coalesce(_cm, {_title_case('_cs')}) END AS ville_std,
    CASE WHEN ville IS NULL OR ville = '' OR _cm IS NULL THEN {q(L.CITY_UNKNOWN)} ELSE {_region_sql('_cm')} END AS region_admin,
    {_contract_sql()} AS type_contrat_std,
    strftime(_dp, '%Y-%m-%d') AS date_publication_std,
    strftime(_de, '%Y-%m-%d') AS date_expiration_std,
    CAST(year(_dp) AS VARCHAR) AS annee,
    lpad(CAST(month(_dp) AS VARCHAR), 2, '0') AS mois,
    NOT coalesce(_dp IS NOT NULL AND _de IS NOT NULL AND _de <= _dp, false) AS date_coherente,
    coalesce(array_to_string(langue_requise, ', '), '') AS langue_requise_txt
  FROM s5
)"""


def _skill_slots(dictionary, text_col: str) -> str:
    """One constant-pattern test per skill -> list of matched structs."""
    slots = []
    for family, skill, aliases in dictionary:
        alts = "|".join(escape(a) for a in aliases)
        pattern = f"(^|{NONWORD})({alts})($|{NONWORD})"
        slots.append(f"CASE WHEN regexp_matches({text_col}, {q(pattern)}) "
                     f"THEN {{'competence': {q(skill)}, 'famille': {q(family)}}} END")
    return "list_filter([" + ",\n      ".join(slots) + "], lambda x: x IS NOT NULL)"


def skills_cte(dictionary=None) -> str:
    dictionary = dictionary or load_dictionary()
    return f"""skill_text AS (
  SELECT id_offre, profil_normalise, ville_std, date_publication, annee, mois, type_contrat_std, salaire_connu,
         lower(concat_ws(' ', nullif(competences_brut, ''), nullif(description, ''))) AS txt
  FROM silver
),
skill_lists AS (
  SELECT *, {_skill_slots(dictionary, 'txt')} AS found FROM skill_text
),
skill_hits AS (
  SELECT * EXCLUDE (found), unnest(CASE WHEN len(found) = 0 THEN [{{'competence': {q(L.SKILL_SENTINEL)}, 'famille': {q(L.FAMILY_SENTINEL)}}}] ELSE found END) AS h
  FROM skill_lists
),
skills AS (
  SELECT id_offre, profil_normalise AS profil, ville_std AS ville, h.competence AS competence, h.famille AS famille,
         date_publication AS date_pub, annee, mois, type_contrat_std AS type_contrat, salaire_connu
  FROM skill_hits
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def base(skills: bool = False) -> str:
    parts = [raw_cte(), silver_cte()]
    if skills:
        parts.append(skills_cte())
    return with_ctes(*parts)
