"""Lexicons: the fixed values every normaliser is parameterised with.

FIXED VALUES. Everything in this module must equal the behaviour being
reproduced (patterns, labels, keyword lists, lookup tables, constants);
it is stated here plainly, in natural order, in one place. The functions
in ``talentlake.functions`` take these as default arguments, so a caller
can pass other lexicons without touching code.

Regex patterns are written in Python ``re`` syntax; the Spark side adds
``(?U)`` so Java's ``\\s \\w \\b \\d`` follow Unicode rules like Python's.
"""

from __future__ import annotations

# --- FIXED VALUES: job title -> profile (all rules applied, LAST match wins)
TITLE_RULES: list[tuple[str, str]] = [
    (r"data\s*eng(ineer|ineer\w*|\.)?|ingénieur\s+data|dev\s+data\b|ingenieur\s+data", "Data Engineer"),
    (r"etl\s*(dev|developer|engineer)|pipeline\s*(dev|engineer)|ingénieur\s+etl", "Data Engineer"),
    (r"big\s*data\s*(eng|engineer|dev)", "Data Engineer"),
    (r"data\s*anal(yst|yste|ytics)|analyste?\s*data|bi\s*anal", "Data Analyst"),
    (r"business\s*intel(ligence)?|ingénieur\s*bi|développeur\s*bi|dev(eloppeur)?\s*bi", "Data Analyst"),
    (r"reporting\s*(anal|spec|officer)", "Data Analyst"),
    (r"data\s*sci(entist|ence)|machine\s*learn|ml\s*(eng|engineer)|ia\s*(eng|engineer)", "Data Scientist"),
    (r"deep\s*learn|nlp\s*(eng|engineer)|computer\s*vision", "Data Scientist"),
    (r"full[\s\-]*stack|fullstack", "Développeur Full Stack"),
    (r"back[\s\-]*end\b|backend", "Développeur Backend"),
    (r"front[\s\-]*end\b|frontend", "Développeur Frontend"),
    (r"développeur\s+mobile|mobile\s+developer|ios\s+dev|android\s+dev", "Développeur Mobile"),
    (r"devops|sre\b|site\s*reliab", "DevOps / SRE"),
    (r"cloud\s*(arch|eng|admin|engineer)|aws\s+eng|gcp\s+eng|azure\s+eng", "Cloud Engineer"),
    (r"cyber|sécurité\s+info|securite\s+info|pentester|soc\s+anal", "Cybersécurité"),
    (r"chef\s+de\s+proj(et)?|project\s+man(ager)?|scrum\s*master", "Chef de Projet IT"),
    (r"architect(e)?\s+(log|tech|data|cloud|sol|solutions?)", "Architecte IT"),
    (r"sys(admin|tème|teme)|réseau|network\s+eng|admin\s+sys", "Admin Systèmes & Réseaux"),
]
TITLE_DEFAULT = "Autre IT"

# --- FIXED VALUES: city -> canonical city (FIRST match wins, case-blind search)
CITY_RULES: list[tuple[str, str]] = [
    (r"casablanca|grand\s+casablanca|casa\b", "Casablanca"),
    (r"rabat", "Rabat"),
    (r"tanger", "Tanger"),
    (r"marrakech|marrakesh", "Marrakech"),
    (r"f[eè]s|fez", "Fès"),
    (r"agadir", "Agadir"),
    (r"oujda", "Oujda"),
    (r"k[eé]nitra", "Kenitra"),
    (r"mekn[eè]s", "Meknès"),
    (r"t[eé]touan", "Tétouan"),
]
CITY_UNKNOWN = "Inconnue"

# --- FIXED VALUES: canonical city -> administrative region
REGIONS: dict[str, str] = {
    "Casablanca": "Casablanca-Settat",
    "Rabat": "Rabat-Salé-Kénitra",
    "Tanger": "Tanger-Tétouan-Al Hoceïma",
    "Marrakech": "Marrakech-Safi",
    "Fès": "Fès-Meknès",
    "Agadir": "Souss-Massa",
    "Oujda": "Oriental",
    "Kenitra": "Rabat-Salé-Kénitra",
    "Meknès": "Fès-Meknès",
    "Tétouan": "Tanger-Tétouan-Al Hoceïma",
}

# --- FIXED VALUES: contract keywords (substring tests, FIRST label wins)
CONTRACT_RULES: list[tuple[list[str], str]] = [
    (["cdi", "permanent", "indéterminée", "full-time cdi"], "CDI"),
    (["cdd", "déterminée", "temporary"], "CDD"),
    (["freelance", "indépendant", "mission", "consultant"], "Freelance"),
    (["stage", "intern", "pfe"], "Stage"),
    (["alternance", "apprentissage"], "Alternance"),
]
CONTRACT_DEFAULT = "Non précisé"

# --- FIXED VALUES: experience text -> (min years, max years)
EXPERIENCE_KEYWORDS: list[tuple[list[str], int, int | None]] = [
    (["débutant", "debutant", "junior", "stage", "sans expérience", "0-1"], 0, 2),
    (["senior confirmé", "expert", "8+"], 8, None),
    (["senior", "confirmé", "lead", "5+"], 5, None),
]
EXPERIENCE_RANGE = r"(\d+)\s*[-àa/]\s*(\d+)"
EXPERIENCE_MIN_ONLY = r"(\d+)\s*(?:\+|ans?|years?)"

# --- FIXED VALUES: pay text parsing
PAY_SENTINELS: list[str] = [
    "null", "confidentiel", "selon profil", "selon experience", "non précisé", "à négocier", "",
]
PAY_DELETE_FIRST: list[str] = [" ", "\u202f"]        # removed before anything else
PAY_CURRENCY_MARKERS_EUR: list[str] = ["eur", "€"]
PAY_UNIT_TOKENS: list[str] = ["eur", "€", "mad", "dh"]  # removed in this order
PAY_K_PATTERN = r"(\d+(?:\.\d+)?)k"
PAY_NUMBER_PATTERN = r"\d+(?:\.\d+)?"
EUR_TO_MAD = 10.8
PAY_MIN_PLAUSIBLE = 3000.0
PAY_MAX_PLAUSIBLE = 100000.0

# --- FIXED VALUES: remote-work predicate (case-blind substring)
REMOTE_KEYWORDS: list[str] = ["télétravail", "teletravail", "remote", "hybride"]

# --- FIXED VALUES: skill extraction
SKILL_SENTINEL = "non_détecté"
FAMILY_SENTINEL = "inconnu"
TOTAL_PROFILE_LABEL = "tous"

# --- FIXED VALUES: bronze partition keys
BRONZE_UNKNOWN_SOURCE = "inconnu"
BRONZE_UNKNOWN_MONTH = "date_inconnue"
BRONZE_SCHEMA_VERSION = "1.0"

# --- FIXED VALUES: analysis parameters
DATA_PROFILES: list[str] = ["Data Engineer", "Data Analyst", "Data Scientist"]
CITY_COMPARISON_PROFILES: list[str] = ["Data Engineer", "Data Analyst", "Data Scientist", "DevOps / SRE"]
MAIN_CITIES: list[str] = ["Casablanca", "Rabat", "Tanger", "Marrakech", "Fès"]
EXPERIENCE_BANDS: list[str] = ["0 — Débutant", "1-2 ans", "3-4 ans", "5-7 ans", "8+ ans Senior"]
EXPERIENCE_BAND_UNKNOWN = "Non précisé"
COMPETITION_LEVELS: list[tuple[float, str]] = [(20000.0, "Compétiteur fort"), (12000.0, "Compétiteur moyen")]
COMPETITION_DEFAULT = "Compétiteur faible / non défini"
COMPETITION_DEFAULT_SCRIPT = "Compétiteur faible"
PIVOT_CITIES: list[str] = ["Casablanca", "Rabat", "Tanger"]
TRUNCATE_AT = 50
TRUNCATE_MARK = "..."
BOX_PROFILES: list[str] = [
    "Data Scientist", "Cloud Engineer", "Data Engineer", "DevOps / SRE", "Chef de Projet IT",
    "Data Analyst", "Développeur Full Stack", "Développeur Backend", "Développeur Frontend",
]
BOX_PAY_RANGE = (3000.0, 80000.0)
BOX_MIN_VALUES = 10
BUBBLE_SCALE = (2000.0, 100.0)   # size = n / max * 2000 + 100

# --- FIXED VALUES: city coordinates (longitude, latitude)
CITY_COORDINATES: dict[str, tuple[float, float]] = {
    "Casablanca": (-7.59, 33.57),
    "Rabat": (-6.84, 34.02),
    "Tanger": (-5.81, 35.78),
    "Marrakech": (-8.01, 31.63),
    "Fès": (-5.00, 34.04),
    "Agadir": (-9.57, 30.42),
    "Oujda": (-1.91, 34.69),
    "Kenitra": (-6.57, 34.26),
    "Meknès": (-5.56, 33.90),
    "Tétouan": (-5.37, 35.57),
}

# --- FIXED VALUES: stand-in term dictionary for documents.text (test fixture)
DOCUMENT_TERMS: dict[str, dict[str, list[str]]] = {
    "articles": {"the": ["the"], "la": ["la"], "der": ["der"]},
    "linkers": {"and": ["and"], "und": ["und"], "que": ["que"]},
    "notices": {"license": ["license"], "copyright": ["copyright"]},
}
