"""Benchmark decontamination with a distributed positional inverted index.

1. The index holds a posting (row, position) for each word of the training texts that
   some benchmark item has too, and one posting at the position after a row's last
   word, which tells its length. It is a table in the shared folder; no later step
   reads the texts again.
2. Benchmark items give windows. Each window is looked up by its two rarest terms, by
   the index's own counts over all documents: their lists, moved back by the terms'
   offsets, are intersected to candidate starts.
3. For the candidates, the lists of all the window's terms are intersected the same
   way. Terms are exact strings (an id stands for a string, never a hash), so a start
   that all lists share is an exact occurrence of the phrase. With ``slop``, a term may
   stand up to that many words off its place: proximity matches.

All steps are joins and aggregations; no Python runs on the executors.

Defined results: null, empty and wordless texts have no words and no hits; null or
wordless items have no window; rows that repeat are judged each; items that repeat
an item_id count once; a null item_id counts as an item but adds nothing to the hash.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from talentlake.llm.common import row_key, written

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = ""  # the term of the posting after a row's last word
SMALL = 1_000_000  # rows (of a few longs each) up to which a side is broadcast, after counting them


def words(text: str) -> Column:
    """Lower-cased A-Z, words of digits, a-z and all non-ASCII characters."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(low, BREAK), "")


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL else df


def phrases(benchmark: DataFrame, window: int) -> DataFrame:
    """(wid, words, items): the distinct windows of all items and whose they are."""
    items = benchmark.select("item_id", words("text").alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - F.lit(window), F.lit(0)))
    each = items.select("item_id", "w", F.explode(starts).alias("s")).select("item_id", F.slice("w", F.col("s") + 1, window).alias("words"))
    distinct = each.groupBy("words").agg(F.collect_set(F.struct(F.col("item_id"))).alias("items"))
    return written(distinct.withColumn("wid", F.monotonically_increasing_id()))


def index(docs: DataFrame, vocabulary: DataFrame, n_terms: int) -> DataFrame:
    """(rid, doc_id, pos, tid): postings of the vocabulary's terms, and of the end."""
    terms = docs.select(row_key().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.array_append(words("text"), END)).alias("pos", "term"))
    return written(terms.join(maybe_broadcast(vocabulary, n_terms), "term").select("rid", "doc_id", "pos", "tid"))


def occurrences(postings: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """(wid, rid, start): where all of a window's terms stand at their places.
    terms: (wid, off, tid, size), a row for each word of each window."""
    counts = postings.groupBy("tid").agg(F.count(F.lit(1)).alias("n"))
    known = terms.join(counts, "tid")
    whole = known.groupBy("wid").agg(F.count(F.lit(1)).alias("have"), F.max("size").alias("size")).where("have = size").select("wid")
    order = W.partitionBy("wid").orderBy("n", "off")
    ranked = written(known.join(whole, "wid", "left_semi").withColumn("rank", F.row_number().over(order)))
    seeds = ranked.where("rank <= 2").select("tid", "wid", "off", "rank", F.least("size", F.lit(2)).alias("need"))
    found = postings.join(maybe_broadcast(seeds, seeds.count()), "tid").select("wid", "rid", "need", "rank", (F.col("pos") - F.col("off")).alias("start"))
    # a term may stand off its place: its posting then speaks for the starts around it
    shift = F.explode(F.when(F.col("rank") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(-slop), F.lit(slop)))).alias("shift")
    if slop:
        found = found.select("*", shift).withColumn("start", F.col("start") + F.col("shift"))
    starts = found.where("start >= 0").groupBy("wid", "rid", "start").agg(F.bit_or(F.col("rank")).alias("ranks"), F.max("need").alias("need"))
    starts = written(starts.where("ranks = if(need = 2, 3, 1)").select("wid", "rid", "start"))
    near = starts.select("rid").distinct()
    rows = postings.join(maybe_broadcast(near, near.count()), "rid", "left_semi").select("rid", "pos", "tid").distinct()
    wanted = starts.join(maybe_broadcast(ranked.select("wid", "off", "tid", "size"), ranked.count()), "wid")
    wanted = wanted.select("wid", "rid", "start", "size", "off", "tid", (F.col("start") + F.col("off")).alias("pos"))
    if slop:
        wanted = wanted.select("*", F.explode(F.sequence(F.col("pos") - slop, F.col("pos") + slop)).alias("at")).drop("pos").withColumnRenamed("at", "pos")
    met = wanted.join(rows, ["rid", "pos", "tid"])
    if slop:
        met = met.groupBy("wid", "rid", "start", "off").agg(F.max("size").alias("size"))
    return met.groupBy("wid", "rid", "start").agg(F.count(F.lit(1)).alias("have"), F.max("size").alias("size")).where("have = size").select("wid", "rid", "start", "size")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row, with
    its row key ``rid`` and the ids of the items as ``items``."""
    found = phrases(benchmark, window)
    term = F.explode("words").alias("term")
    vocabulary = written(found.select(term).distinct().unionByName(found.sparkSession.range(1).select(F.lit(END).alias("term"))).withColumn("tid", F.monotonically_increasing_id()))
    n_terms = vocabulary.count()
    end = vocabulary.where(F.col("term") == END).first()["tid"]
    postings = index(docs, vocabulary, n_terms)
    terms = found.select("wid", F.size("words").alias("size"), F.posexplode("words").alias("off", "term")).join(vocabulary, "term").drop("term")
    met = written(occurrences(postings.where(F.col("tid") != end), terms, slop))
    hit = met.select("rid", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("pos"))
    hit = hit.groupBy("rid", "pos").agg(F.lit(1).alias("one")).groupBy("rid").agg(F.sum("one").cast("long").alias("n_hit"))
    owners = met.select("rid", "wid").distinct().join(found.select("wid", F.explode("items.item_id").alias("item_id")), "wid")
    owners = owners.groupBy("rid", "item_id").agg(F.lit(1).alias("one"))
    owners = owners.groupBy("rid").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    rows = postings.where(F.col("tid") == end).select("rid", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = rows.join(hit.join(owners, "rid"), "rid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("rid", "doc_id", "n_words", zero("n_hit"), zero("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), ids.alias("items"))
