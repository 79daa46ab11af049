"""URL filters: rules indexed by their rarest literal token.

Two kinds of rules run on ``host + path`` of a URL. A site rule names a host, with all its
subdomains, and the start of a path; the longest that fits decides. A pattern is text in
which ``*`` stands for anything and ``^`` for a separator or an end; patterns decide where
no site rule does, and the verdict is ``allow`` where nothing fits.

Every rule is indexed by one of its literal tokens, runs of letters and digits that any URL
it fits must have whole: the one that occurs in the fewest URLs. Distinct URLs are cut into
tokens, tokens fetch candidate rules, and only those run their regular expression. All of it
is joins and expressions; the rules are broadcast only if Spark knows that they are small.

Defined results
- A NULL URL, or one without ``://``, has an empty host and path; no rule fits it.
- Repeated rows are judged alike; other columns pass through, and one that has the name of
  an added column is replaced. Empty tables give empty results.
- Of rules that fit and are equally long the one that comes first as a string decides;
  a pattern to block goes before one to allow.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registrylake.operators.joins import join_on_key

ALLOW, BLOCK = "allow", "block"

#: Verdict and site rule.
SITE_RULES = (
    (ALLOW, "com/"),
    (BLOCK, "example.com/en/"),
    (ALLOW, "www.example.com/en/"),
    (BLOCK, "net/es/"),
    (BLOCK, "net/fr/"),
)
#: Verdict and pattern.
PATTERNS = (
    (BLOCK, "^casino^"),
    (BLOCK, "^poker^"),
    (BLOCK, "^free-bets^"),
    (BLOCK, "^ads-track^"),
    (BLOCK, "^adserver^"),
    (BLOCK, "^porn^"),
    (BLOCK, "^xxx^"),
    (BLOCK, "^payday-loans^"),
    (BLOCK, "^warez^"),
    (BLOCK, "^wp-login.php^"),
    (ALLOW, "^casino-history^"),
)



def listed_patterns(languages: Sequence[str] = ("de", "es"), last: int = 10_000) -> list[tuple[str, str]]:
    """Patterns that block single pages by language and number, one in five: a long list."""
    return [(BLOCK, f"/{language}/{n}^") for language in languages for n in range(3, last, 5)]


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_TOKEN = ""


def site_regex(rule: str) -> str:
    return rf"^(?:[^/]*\.)?{_quoted(rule)}"


def pattern_regex(pattern: str) -> str:
    parts = {"*": ".*", "^": "(?:^|[^a-z0-9]|$)"}
    return "(?is)" + "".join(parts.get(char) or _quoted(char) for char in pattern)


def _quoted(text: str) -> str:
    """Regular expression of the text itself, alike in Java and elsewhere."""
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def literal_tokens(rule: str, is_pattern: bool) -> list[str]:
    """Tokens that every URL that the rule fits has whole; at worst the empty token.

    A run of letters and digits at the end of a rule, or of a pattern's text next to ``*``,
    may be the piece of a longer token, so it does not count.
    """
    start = "*" if is_pattern else "."
    text = f"{start}{rule.lower()}*"
    whole = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", text)
    return whole or [_NO_TOKEN]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_table(
    spark: SparkSession,
    sites: Sequence[tuple[str, str]] = SITE_RULES,
    patterns: Sequence[tuple[str, str]] = PATTERNS,
) -> DataFrame:
    """``rule, verdict, regex, site, tokens`` of all rules."""
    rows = [(r, v, site_regex(r), True, literal_tokens(r, False)) for v, r in sites]
    rows += [(r, v, pattern_regex(r), False, literal_tokens(r, True)) for v, r in patterns]
    kind = "rule string, verdict string, regex string, site boolean, tokens array<string>"
    return spark.createDataFrame(rows, kind)


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The pages with ``host``, ``path``, the site ``rule`` that decides, and the ``verdict``."""
    added = ("host", "path", "rule", "verdict", "pattern")
    columns = [name for name in pages.columns if name not in added]
    # The columns of the pages travel as one, so that none has the name of a working column.
    located = pages.select(
        F.struct(*columns).alias("page"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    ).withColumn("place", F.concat("host", "path"))
    places = located.select("place").where("place != ''").distinct()
    cut = F.split(F.translate("place", _UPPER, _LOWER), "[^a-z0-9]+", -1)
    tokens = places.select(
        "place", F.explode(F.array_distinct(F.concat(cut, F.array(F.lit(_NO_TOKEN))))).alias("token")
    )

    literals = rules.select("rule", "site", F.explode("tokens").alias("token"))
    known = tokens.join(literals.select("token").distinct(), "token", "left_semi")
    seen = known.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literals.join(seen, "token", "left")
        .groupBy("rule", "site")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    index = rarest.join(rules.drop("tokens"), ["rule", "site"])
    fitting = tokens.join(index, "token").where("place RLIKE regex")
    name, verdict = F.col("rule"), F.col("verdict")
    site = F.struct((-F.length(name)).alias("order"), name, verdict)
    pattern = F.struct((verdict != BLOCK).alias("order"), name, verdict)
    decided = fitting.groupBy("place").agg(
        F.min(F.when(F.col("site"), site)).alias("by_site"),
        F.min(F.when(~F.col("site"), pattern)).alias("by_pattern"),
    )
    # Pages without a place stay out of the join, and a place of very many pages is split.
    judged = join_on_key(located.where("place != ''"), decided, "place", "left")
    nowhere = located.where("place = ''")
    return judged.unionByName(nowhere, allowMissingColumns=True).select(
        *[F.col(f"page.`{column}`").alias(column) for column in columns],
        "host",
        "path",
        F.col("by_site.rule").alias("rule"),
        F.coalesce("by_site.verdict", "by_pattern.verdict", F.lit(ALLOW)).alias("verdict"),
        F.col("by_pattern.rule").alias("pattern"),
    )
