"""Who wrote a plot file, what a stored record says of its making, and the rows of failures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mark of files fetched for the pairs, and how long notes and reasons may be.
FOR_PAIRS = "pairs"
MOST_NOTES, MOST_REASON = 500, 1000


def clipped(text: Column, most: int) -> Column:
    """A text of at most so many characters; one that was cut ends in three dots."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, most - 3), F.lit("...")))


def visible(found: Column, fetched_for: Column, include_pairs: bool = False) -> Column:
    """Whether a title's plot file counts as present: one that was fetched for the pairs alone does so only for them."""
    return found if include_pairs else found & ~fetched_for.eqNullSafe(F.lit(FOR_PAIRS))


def pairs_own(found: Column, fetched_for: Column) -> Column:
    """Whether a fetch for the pairs may write a title's plot file: there is none, or it is their own."""
    return ~found | fetched_for.eqNullSafe(F.lit(FOR_PAIRS))


def notes(attempts: Column, effort: Column, cache_written: Column, request_id: Column) -> Column:
    """The free text of a record's making; what is missing reads None."""
    said = {"attempts": attempts, "effort": effort, "cache_creation_input_tokens": cache_written, "request_id": request_id}
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit("None"))) for k, v in said.items()]
    return clipped(F.concat_ws("; ", *parts), MOST_NOTES)


def provenance(run: dict[str, Column], usage: dict[str, Column], sources: Column, words: Column, note: Column, coverage: Column) -> Column:
    """The provenance of a record. ``run`` names annotated_at, model_version, prompt_version and run_id, ``usage`` the token
    counts and batch; ``coverage`` is null where the request stated none."""
    annotator = F.struct(*[run[k].alias(k) for k in ("model_version", "prompt_version", "run_id")])
    used = F.struct(*[usage[k].alias(k) for k in ("input_tokens", "output_tokens", "cache_read_input_tokens", "batch")])
    return F.struct(
        F.date_format(run["annotated_at"], "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("annotated_at"), annotator.alias("annotator"), sources.alias("sources"), words.alias("input_word_count"),
        used.alias("usage"), note.alias("notes"), coverage.alias("coverage"),
    )
