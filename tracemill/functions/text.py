"""Text predicates and small string helpers as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Account name fragments, phrases and the issue-link pattern.
BOT_SUFFIX = "[bot]"
BOT_FRAGMENTS = [
    "dependabot", "renovate", "github-actions", "pre-commit-ci", "snyk-bot", "deepsource", "imgbot",
]
TRIVIAL_PHRASES = [
    "lgtm", "looks good", "thanks", "thank you", "+1", "approved", "nice", "nit", "ok", "okay", "done",
]
MEANINGFUL_LENGTH = 30
CLOSING_PATTERN = r"(?i)\b(fix|fixes|fixed|close|closes|closed|resolve|resolves|resolved)\s+#(\d+)"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space at both ends (``trim`` only takes blanks)."""
    return F.btrim(text, F.lit(WHITESPACE))


def nonempty(text: Column) -> Column:
    """True for a present, non-empty string; never null."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.when(F.length(text) > 0, text)


def is_bot_login(login: Column) -> Column:
    low = F.lower(login)
    hit = reduce(or_, [low.contains(f) for f in BOT_FRAGMENTS], low.endswith(BOT_SUFFIX))
    return F.coalesce(hit, F.lit(False))


def is_meaningful_comment(body: Column) -> Column:
    """Long enough after trimming and lower-casing, and no stock phrase.

    Stock phrases are shorter and lower-casing drops no character, so a long
    text is mostly told by its head; only what the head leaves open is read whole.
    """
    text = F.lower(strip(body))
    whole = F.coalesce((F.length(text) >= MEANINGFUL_LENGTH) & ~text.isin(TRIVIAL_PHRASES), F.lit(False))
    return F.when(F.length(strip(F.substring(body, 1, 2 * MEANINGFUL_LENGTH))) >= MEANINGFUL_LENGTH, True).otherwise(whole)


def linked_issue_number(title: Column, body: Column) -> Column:
    text = F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))
    return F.regexp_extract(text, CLOSING_PATTERN, 2).try_cast("long")


def candidate_key(repo: Column, number: Column) -> Column:
    return F.concat(repo, F.lit("#"), number.try_cast("long").cast("string"))


def repo_owner(repo: Column) -> Column:
    return F.get(F.split(repo, "/", 2), F.lit(0))


def repo_short_name(repo: Column) -> Column:
    return F.get(F.split(repo, "/", 2), F.lit(1))


def example_id(repo: Column, number: Column) -> Column:
    return F.concat(
        F.replace(F.coalesce(blank_to_null(repo), F.lit("unknown_repo")), F.lit("/"), F.lit("__")),
        F.lit("__pull_"),
        F.coalesce(number.cast("string"), F.lit("unknown_pr")),
    )


def safe_name(text: Column) -> Column:
    low = F.regexp_replace(F.regexp_replace(F.lower(text), r"\+", "plus"), "#", "sharp")
    slug = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(blank_to_null(slug), F.lit("unknown"))


_CLOCK = r"([01][0-9]|2[0-3])(:?[0-5][0-9](:?[0-5][0-9]([.,][0-9]+)?)?)?"
_ZONE = r"(Z|[+-][0-9]{2}(:?[0-9]{2}(:?[0-9]{2}([.][0-9]+)?)?)?)?"
_ISO = rf"^([0-9]{{4}})(-?)([0-9]{{2}})\2([0-9]{{2}})([^0-9]{_CLOCK}{_ZONE})?$"


# The shapes that nearly all dates have, digits written as 0.
_PLAIN = ["0000-00-00T00:00:00Z", "0000-00-00T00:00:00", "0000-00-00"]


def day_key(iso: Column) -> Column:
    """The day as written, ``yyyy-MM-dd``, of a date or date-time in ISO form; null for anything else.

    The offset is not applied and no session setting matters. The common shapes
    are told by position; only what looks otherwise is matched by patterns.
    """
    part = lambda k: F.regexp_extract(iso, _ISO, k)
    at = lambda start, most: F.substring(iso, start, 2) <= most
    plain = F.translate(iso, "123456789", "000000000").isin(_PLAIN) & at(12, "23") & at(15, "59") & at(18, "59")
    other = F.when(iso.rlike(_ISO), F.concat_ws("-", part(1), part(3), part(4)))
    day = F.when(plain, F.substring(iso, 1, 10)).otherwise(other)
    return F.when(F.try_to_date(day, "yyyy-MM-dd").isNotNull() & ~day.startswith("0000"), day)


def month_key(iso: Column) -> Column:
    return F.substring(day_key(iso), 1, 7)


def seeded_digest(seed: int, key: Column) -> Column:
    """Repeatable pseudo-random order: the same digest on every run and engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def or_none(value: Column) -> Column:
    """Text form with nulls spelled out, for templates that show missing fields."""
    return F.coalesce(value.cast("string"), F.lit("None"))
