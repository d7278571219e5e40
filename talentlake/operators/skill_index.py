"""Skill extraction with a dictionary of any size: a join on token n-grams.

``extract_skills`` compiles a dictionary into one expression for each skill, which suits some
hundred skills. Here the dictionary is a table of aliases of any number of rows, and the
match is an equi-join (broadcast or shuffled, as sizes have it):

1. A text is cut into runs of word characters and what stands between them. An alias that
   occurs as a whole word has its own runs, whole and in the same order, in the text: its key.
2. Each text gives its n-grams of runs, up to the longest alias, each with its context: the
   runs as they stand, with what is between and beside them. Keys join; the alias is then
   looked for in the context, with the same boundaries as ``extract_skills`` has.
3. An alias without a word character (``++``) has no run; its key is its own text, met by the
   pieces of the text between runs that are as long as such an alias.
4. Matches are made distinct by listing row and skill; rows without one get the sentinel.

The result is that of ``extract_skills``: a skill is found if any of its aliases is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake import lexicons as L
from talentlake.operators.skills import skill_text
from talentlake.session import materialize

WORD = r"[\p{L}\p{N}_]+"
JOINT = "\x01"  # between the runs of a key; no run has it
KEYS = ["id_offre", "profil_normalise", "ville_std", "date_publication", "annee", "mois", "type_contrat_std", "salaire_connu"]


def runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def alias_index(aliases: DataFrame) -> DataFrame:
    """(key, parts, alias, competence, famille) from a table (famille, competence, alias): aliases
    in lower case, empty ones left out; parts is the number of runs, 0 for an alias without one."""
    low = aliases.select("famille", "competence", F.lower("alias").alias("alias")).where("alias <> ''").distinct()
    r = runs(F.col("alias"))
    return low.select(F.when(F.size(r) > 0, F.array_join(r, JOINT)).otherwise(F.col("alias")).alias("key"), F.size(r).alias("parts"), "alias", "competence", "famille")


def grams(texts: DataFrame, longest: int, bare: list[int]) -> DataFrame:
    """(row, key, parts, context): the n-grams of runs of each text (``row``, ``_txt``), distinct in
    it, and the pieces between runs of the lengths ``bare``."""
    r, s = F.col("_r"), F.col("_s")
    cut = texts.select("row", runs(F.col("_txt")).alias("_r"), F.split("_txt", WORD).alias("_s"))
    # one struct for each length n from place i: its runs, and these with what is between and beside
    # them; an x stands for the run on either side, as what is beside ends there
    beyond = lambda there: F.when(there, F.lit("x")).otherwise("")
    spelled = lambda i, n: F.concat(beyond(i > 0), F.array_join(F.transform(F.sequence(i, i + n - 1), lambda j: F.concat(F.get(s, j), F.get(r, j))), ""), F.get(s, i + n), beyond(i + n < F.size(r)))
    gram = lambda i, n: F.struct(F.array_join(F.slice(r, i + 1, n), JOINT).alias("key"), n.cast("int").alias("parts"), spelled(i, n).alias("context"))
    places = F.when(F.size(r) > 0, F.sequence(F.lit(0), F.size(r) - 1)).otherwise(F.array().cast("array<int>"))
    every = F.flatten(F.transform(places, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size(r) - i)), lambda n: gram(i, n))))
    if bare:
        piece = lambda x, n: F.transform(F.when(F.length(x) >= n, F.sequence(F.lit(1), F.length(x) - n + 1)).otherwise(F.array().cast("array<int>")),
                                         lambda i: F.struct(F.substring(x, i, F.lit(n)).alias("key"), F.lit(0).alias("parts"), F.substring(x, i, F.lit(n)).alias("context")))
        # a piece at the edge of what stands between runs has a word character beside it: those do not count
        inner = F.transform(s, lambda x, i: F.substring(x, F.when(i == 0, 1).otherwise(2), F.length(x) - F.when(i == 0, 0).otherwise(1) - F.when(i == F.size(s) - 1, 0).otherwise(1)))
        pieces = lambda n: F.flatten(F.transform(inner, lambda x: piece(x, n)))
        every = F.concat(every, *[pieces(n) for n in bare])
    return cut.select("row", F.inline(F.array_distinct(every)))


def extract_skills_indexed(silver: DataFrame, aliases: DataFrame) -> DataFrame:
    """Silver listings and a table of aliases (famille, competence, alias) -> one row for each
    (listing, skill), the sentinel row for listings without a skill. Listings are written once with a
    number of their own, as ids may repeat, and the keys of the dictionary once."""
    index = materialize(alias_index(aliases))
    size = index.agg(F.coalesce(F.max("parts"), F.lit(0)).alias("longest"), F.collect_set(F.when(F.col("parts") == 0, F.length("alias"))).alias("bare")).first()
    listings = materialize(silver.select(*KEYS, skill_text(F.col("competences_brut"), F.col("description")).alias("_txt")).withColumn("row", F.monotonically_increasing_id()))
    if not size["longest"] and not size["bare"]:
        found = listings.select("row", F.lit(None).cast("string").alias("competence"), F.lit(None).cast("string").alias("famille")).limit(0)
    else:
        met = grams(listings.select("row", F.coalesce("_txt", F.lit("")).alias("_txt")), max(1, size["longest"]), sorted(size["bare"])).join(index, ["key", "parts"])
        # a key of one run is the alias itself where it has no other characters
        quoted = F.replace("alias", F.lit(r"\E"), F.lit(r"\E\\E\Q"))
        pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}_])\Q"), quoted, F.lit(r"\E(?![\p{L}\p{N}_])"))
        whole = (F.col("key") == F.col("alias")) | F.rlike("context", pattern)
        found = met.where(whole).select("row", "competence", "famille").distinct()
    named = listings.drop("_txt").join(found, "row", "left")
    return named.select(
        "id_offre", F.col("profil_normalise").alias("profil"), F.col("ville_std").alias("ville"),
        F.coalesce(F.col("competence"), F.lit(L.SKILL_SENTINEL)).alias("competence"), F.coalesce(F.col("famille"), F.lit(L.FAMILY_SENTINEL)).alias("famille"),
        F.col("date_publication").alias("date_pub"), "annee", "mois", F.col("type_contrat_std").alias("type_contrat"), "salaire_connu")
