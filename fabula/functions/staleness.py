"""When a plot file is fetched again: the rules by version of the fetcher that wrote it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fabula.functions import records
from fabula.functions.classify import version
from fabula.functions.gates import reasons
from fabula.functions.text import sentences

#: Columns of a plot file that the rules read; an entry that the file lacks is null.
FILE = (
    "qid string, status string, skip_reason string, fetcher_version string, media_type string, via string, via_detail string, word_count int, "
    "season_articles struct<status:string,evidence:array<struct<basis:string>>,skipped:array<struct<title:string,reason:string>>>, "
    "episode_tables struct<evidence:array<struct<basis:string>>>, sources array<struct<text:string>>"
)
# The first version of the fetcher that each rule accepts, the version with wrong year headings, and the least words of a rich text.
SINCE = {
    "current_ingest": "1.4.0", "episode_tables": "1.5.0", "run_rule": "1.5.1", "list_link": "1.5.2", "richer_text": "1.5.2", "link_hardening": "1.5.6", "year_heading": "1.5.6",
    "episode_marker": "1.5.7", "episode_text": "1.5.8", "prefer_episode_text": "1.5.8", "trivia_rules": "1.5.9",
}
YEAR_HEADING_WRONG, RICHER_WORDS = "1.5.5", 500
# Fixed value: the marker that begins an episode's paragraph.
MARKER = r'^(?:S\d+|\d{4})E\d+(?:–\d+)?(?: "[^"]*"| “[^”]*”)?: '


def _has_trivia(text: Column) -> Column:
    """Whether any paragraph of an episode text, without its marker, holds a remark."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n\n")
    return F.exists(paragraphs, lambda p: F.exists(sentences(F.regexp_replace(p, MARKER, "")), lambda s: records.trivia_rule(s).isNotNull()))


def fetch_reasons(run_rules: Mapping[str, str], priority: Sequence[str], prefer_episode_text: Sequence[str], richer_words: int = RICHER_WORDS) -> Column:
    """Why a plot file with the columns of ``FILE`` is fetched again, as an array; empty if it need not be. ``run_rules`` gives
    by series the version since which its rule has its present form. A title without a file is the caller's case."""
    c, wrote = F.col, version(F.col("fetcher_version"))
    older = lambda v: wrote < version(F.lit(v))
    sure = lambda x: F.coalesce(x, F.lit(False))
    any_of = lambda name, test: sure(F.exists(c(name), test))
    among = lambda values: sure(c("qid").isin(*values)) if values else F.lit(False)
    series, ok = sure(c("media_type") == "tv_series"), sure(c("status") == "ok")
    failed = sure(c("skip_reason") == "fetch_error")
    tried_seasons = series & sure(c("skip_reason").isin("too_short", "no_plot_section", "season_too_long")) & c("season_articles").isNotNull() & sure(~c("season_articles.status").eqNullSafe(F.lit("disabled")))
    from_tables = ok & sure(c("via_detail") == "episode_table")
    # versions that differ by series are compared in order, as the array form allows
    parts = lambda v: tuple(map(int, v.split(".")))
    by_series = lambda v: F.coalesce(*[F.when(c("qid") == q, older(max(v, own, key=parts))) for q, own in run_rules.items()], older(v))
    linked = lambda e: sure(e["basis"] == "main_article_link")
    rules = [
        ("fetch_error", failed), ("current_ingest", older(SINCE["current_ingest"])),
        ("seasons", series & sure(c("skip_reason").isin("too_short", "no_plot_section")) & c("season_articles").isNull()),
        ("episode_tables", tried_seasons & older(SINCE["episode_tables"])), ("run_rule", among(tuple(run_rules)) & series & ~failed & by_series(SINCE["run_rule"])),
        ("list_link", tried_seasons & older(SINCE["list_link"]) & any_of("season_articles.skipped", lambda s: sure(s["title"].startswith("List of") & s["reason"].startswith("unverified")))),
        ("richer_text", among(priority) & ok & series & c("via").isNull() & sure(c("word_count") < richer_words) & older(SINCE["richer_text"])),
        ("link_hardening", older(SINCE["link_hardening"]) & (any_of("season_articles.evidence", linked) | any_of("episode_tables.evidence", linked) | any_of("season_articles.skipped", lambda s: sure(s["reason"].contains("in another"))))),
        ("year_heading", c("episode_tables").isNotNull() & ~older(YEAR_HEADING_WRONG) & by_series(SINCE["year_heading"])), ("episode_marker", from_tables & older(SINCE["episode_marker"])),
        ("episode_text", c("episode_tables").isNotNull() & older(SINCE["episode_text"])), ("prefer_episode_text", among(prefer_episode_text) & older(SINCE["prefer_episode_text"])),
        ("trivia_rules", from_tables & older(SINCE["trivia_rules"]) & any_of("sources", lambda s: _has_trivia(s["text"]))),
    ]
    return reasons(rules)
