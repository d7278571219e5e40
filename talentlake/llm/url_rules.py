"""URL filters: pattern rules indexed by their rarest literal token.

A rule needs literal tokens: runs between breaks (``.``, ``/``, ``-``) that each url it
fits has whole. For prefix rules these are parts of the host's labels and of the complete
segments of the path; for patterns they are read off the parsed regular expression.
Tokens are counted over all urls, and each rule is filed under its rarest one. A url fetches the rules filed under its own tokens, and runs the
regular expressions of those alone; a rule that it doesn't fetch lacks a token that
the rule needs. Rules without a literal token are filed under a token that every
url has. All steps are joins and aggregations over distinct urls.

Two kinds of rules:
* prefix rules (host, path, verdict): for the host and its subdomains, and paths that
  start so. The longest decides; of equally long ones the block, then the first by text.
* pattern rules (kind, regex), the method's own: where no prefix rule fits, a url whose host
  and path match one is blocked, and all others are allowed. PATTERNS has one for each entry of
  WORDS: a word blocks as a part of the host, but not in a path, where a page may be about it; a
  phrase blocks in the host and in the path. Patterns see host and path with A-Z lower-cased,
  and are to be written so; prefix rules see the path as it is written.

Defined results: null urls and those without ``://`` have an empty host and path, fit no
rule and are allowed; rows that repeat are judged alike.
"""

from __future__ import annotations

import re
import re._constants as sre
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

ANY = ""  # a token of every url
SMALL = 100_000  # rules up to which their index is broadcast
BREAK = r"[./-]+"
# What the method blocks by itself, by kind.
WORDS = {
    "spam": ["spam", "link-farm", "spam-farm", "buy-backlinks", "get-rich-quick", "make-money-fast"],
    "gambling": ["casino", "casinos", "bet-bonus", "casino-win", "free-bets", "free-spins", "online-betting", "online-poker", "poker-bonus", "slot-machines", "sports-betting", "win-jackpot"],
    "pharma": ["cialis", "levitra", "viagra", "buy-pills", "cheap-meds", "cheap-pills", "diet-pills", "no-prescription", "online-pharmacy", "weight-loss-pills"],
    "adult": ["porn", "porno", "xxx", "adult-chat", "adult-dating", "adult-videos", "adult-x", "escort-girls", "live-sex", "nude-cams", "sex-cams", "sex-chat"],
    "ads": ["adserver", "doubleclick", "popunder", "ad-click", "ad-server", "ad-track", "ads-click", "ads-track", "click-track", "click-tracker", "track-click", "tracking-pixel"],
    "malware": ["malware", "phishing", "warez", "crack-download", "free-cracks", "free-keygen", "keygen-download", "serial-keys", "trojan-download"],
}
PATTERNS = [(kind, rf"(?<![^./-]){w.replace('-', '[.-]')}(?![^./-])" if "-" in w else rf"^([^/]*[.-])?{w}[.-]") for kind, words in WORDS.items() for w in words]


def host() -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, ascii_uppercase, ascii_lowercase)


def path() -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def literal_tokens(host: str, path: str) -> list[str]:
    """Tokens that each url which the rule fits has whole: the last one of the path may go on in the url."""
    return sorted({x for x in [*re.split(BREAK, host), *re.split(BREAK, path)[:-1]] if x}) or [ANY]


def breaks_only(item: tuple) -> bool:
    """Whether a parsed item is one character, and that a break."""
    op, arg = item
    return op is sre.LITERAL and chr(arg) in "./-" or op is sre.IN and all(o is sre.LITERAL and chr(c) in "./-" for o, c in arg)


def bounded(items: list[tuple], side: int) -> bool:
    """Whether what comes after (side 1) or before (side -1) the parsed items begins or ends a token:
    a break is next to it, or for side -1 the begin of the url."""
    if not items:
        return False
    (op, arg), rest = (items[0], items[1:]) if side > 0 else (items[-1], items[:-1])
    if op is sre.SUBPATTERN:
        return bounded([*arg[-1], *rest] if side > 0 else [*rest, *arg[-1]], side)
    if op is sre.MAX_REPEAT:
        return bounded(list(arg[2]), side) and (arg[0] > 0 or bounded(rest, side))
    if op is sre.BRANCH:
        return all(bounded([*x, *rest] if side > 0 else [*rest, *x], side) for x in arg[1])
    if op is sre.ASSERT_NOT and arg[0] == side and len(arg[1]) == 1:  # no other than a break
        kind, chars = arg[1][0]
        return kind is sre.NOT_LITERAL and chr(chars) in "./-" or kind is sre.IN and chars[0][0] is sre.NEGATE and breaks_only((sre.IN, chars[1:]))
    return breaks_only((op, arg)) or side < 0 and op is sre.AT and arg in (sre.AT_BEGINNING, sre.AT_BEGINNING_STRING)


def pattern_tokens(regex: str) -> list[str]:
    """Tokens that each url which the expression fits has whole: runs of literals in a row
    that every match needs, with a break or the begin on both sides. Ends don't count,
    as ``$`` also fits before a last line break."""
    parsed = re._parser.parse(regex, re.S)
    if parsed.state.flags & (re.I | re.M | re.X):
        return [ANY]

    def flat(items) -> list[tuple]:
        plain = lambda op, arg: op is sre.SUBPATTERN and not arg[1] and not arg[2]
        return [y for op, arg in items for y in (flat(arg[3]) if plain(op, arg) else [(op, arg)])]

    items, out = flat(parsed), set()
    literal = [op is sre.LITERAL and chr(arg) not in "./-" for op, arg in items]
    for a in range(len(items)):
        if literal[a] and (not a or not literal[a - 1]):
            b = next((k for k in range(a, len(items)) if not literal[k]), len(items))
            if bounded(items[:a], -1) and bounded(items[b:], 1):
                out.add("".join(chr(arg) for _, arg in items[a:b]))
    return sorted(out) or [ANY]


def rule_rows(rules: list[tuple[str, str, str]], patterns: list[tuple[str, str]]) -> list[tuple]:
    """(id, token, regex, rule, verdict, size): a row for each literal token of each rule."""
    out = []
    for k, (h, p, verdict) in enumerate(rules):
        regex = r"(?s)^(?:[^/]*\.)?" + "".join(re.escape(c) if c.isascii() else c for c in h + p)
        out += [(k, t, regex, h + p, verdict, len(h + p)) for t in literal_tokens(h, p)]
    return out + [(len(rules) + k, t, "(?s)" + regex, None, "block", -1) for k, (_, regex) in enumerate(patterns) for t in pattern_tokens(regex)]


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], patterns: list[tuple[str, str]] = PATTERNS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row."""
    spark = pages.sparkSession
    urls = pages.select("url").where("url is not null").distinct().select("url", host().alias("h"), path().alias("p"))
    urls = urls.withColumn("l", F.translate("p", ascii_uppercase, ascii_lowercase))
    # the path's own tokens for prefix rules, and in lower case for patterns
    tokens = F.array_append(F.array_distinct(F.array_remove(F.split(F.concat_ws("/", "h", "p", "l"), BREAK), "")), ANY)
    held = urls.select("url", F.concat("h", "p").alias("at"), F.concat("h", "l").alias("low"), F.explode(tokens).alias("token"))
    rows = spark.createDataFrame(rule_rows(rules, patterns), "id int, token string, regex string, rule string, verdict string, size int")
    few = F.broadcast if len(rules) + len(patterns) <= SMALL else (lambda x: x)
    seen = held.join(few(rows.select("token").distinct()), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.row_number().over(W.partitionBy("id").orderBy(F.coalesce("n", F.lit(0)), "token"))
    filed = rows.join(seen, "token", "left").withColumn("k", rarest).where("k = 1").drop("k", "n", "id")
    fits = held.join(few(filed), "token").where(F.regexp_like(F.when(F.col("size") < 0, F.col("low")).otherwise(F.col("at")), F.col("regex")))
    best = F.max(F.struct("size", (F.col("verdict") == "block").alias("blocks"), F.col("rule"), "verdict"))
    found = fits.groupBy(F.col("url").alias("u")).agg(best.alias("best"))
    out = pages.select("page_id", "url").join(found, F.col("url") == F.col("u"), "left")
    return out.select("page_id", host().alias("host"), path().alias("path"), F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
