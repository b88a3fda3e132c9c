"""Gates: rules whose first failure names a reason, and lists of all failures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of pages that are no articles.
NAMESPACES = ("talk", "user", "wikipedia", "file", "template", "help", "category", "portal", "draft", "special", "module", "media")
RFC3339 = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])[Tt]([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$"


def reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """Names of all rules that hold."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules]))


def rising(values: Column) -> Column:
    """Whether an array is strictly increasing."""
    return F.array_sort(F.array_distinct(values)) == values


def url_reason(url: Column, hosts: Column) -> Column:
    """Why a reference is no plain article address, or null: scheme, host, query or fragment, empty or forbidden title."""
    host = F.regexp_extract(url, r"^[a-z]+://([^/?#]*)", 1)
    title = F.regexp_extract(url, r"^[a-z]+://[^/?#]*/[^/?#]*/([^?#]*)", 1)
    prefix = F.lower(F.regexp_extract(title, r"^([^:]*):", 1))
    return F.coalesce(
        F.when(~url.startswith("https://"), "scheme"), F.when(~hosts, "host"), F.when(url.rlike(r"[?]"), "query"), F.when(url.contains("#"), "fragment"),
        F.when(host == "", "no_host"), F.when(title == "", "no_title"), F.when(F.length(title) > 255, "too_long"), F.when(prefix.isin(*NAMESPACES), F.concat(F.lit("namespace:"), prefix)),
        F.when(title.rlike(r"[\[\]{}|<>]"), "forbidden"),
    )


def is_rfc3339(stamp: Column) -> Column:
    """A date and time with offset that exist."""
    return F.coalesce(stamp.rlike(RFC3339) & F.try_to_timestamp(F.upper(stamp)).isNotNull(), F.lit(False))
