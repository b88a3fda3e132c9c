"""Text functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: letters and digits, joined by apostrophes or hyphens. Spelt without \\w, which differs between engines.
WORD = r"[\p{L}\p{N}]+(?:['’\-][\p{L}\p{N}]+)*"

# Words after whose full stop a sentence goes on.
ABBREVIATIONS = ("Dr.", "Mr.", "Mrs.", "Ms.", "Lt.", "Capt.", "Sgt.", "Col.", "Maj.", "Gen.", "St.", "Jr.", "Sr.", "Prof.", "Rev.", "No.", "Cpl.", "Pvt.", "Adm.", "Cmdr.", "Det.", "Insp.", "Supt.")
def word_count(text: Column) -> Column:
    """Words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sha256(text: Column) -> Column:
    """Hex digest of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def token_estimate(text: Column, chars_per_token: float) -> Column:
    """Tokens of a text from its code points, rounded up: 3.5 characters a token in prose, 2 in schema JSON."""
    return F.ceil(F.length(text) / F.lit(chars_per_token)).cast("long")


def heading(line: Column) -> Column:
    """A heading without tags, in lower case, white space squeezed, without a closing colon or full stop."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(line, "<[^>]*>", ""), r"\s+", " "))
    return F.regexp_replace(F.lower(bare), r"[:.]+$", "")


def heading_class(h: Column) -> Column:
    """What a normalised heading is: non-plot with the heading or word that says so, a plot heading, or open."""
    from fabula.functions import sections as S

    return F.when(S.nonplot_word(h).isNotNull(), F.concat(F.lit("nonplot:"), S.nonplot_word(h))).when(S.is_plot_heading(h), "plot").otherwise("open")


def nonplot_share(text: Column, cues: str | None = None, separator: str = "\n\n") -> Column:
    """Share of words in paragraphs with at least two cues and 2.5 of them per 100 words; 0 without words. cues: a pattern, else that of writing about production, broadcast and reception."""
    from fabula.functions import sections as S

    cues = cues or S.cue_pattern()

    def add(s: Column, p: Column) -> Column:
        n, hits = word_count(p), F.regexp_count(p, F.lit(cues))
        return F.struct((s["words"] + n).alias("words"), (s["flagged"] + F.when((hits >= S.LEAST_HITS) & (hits * 100 >= n * S.LEAST_IN_100), n).otherwise(0)).alias("flagged"))

    zero = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("flagged"))
    return F.aggregate(F.split(text, separator), zero, add, lambda s: F.when(s["words"] > 0, s["flagged"] / s["words"]).otherwise(0.0))


#: A dot that ends no sentence, after an abbreviation or an initial; and the end of one.
GUARDED = r"(^|[^\p{L}\p{N}])(" + "|".join(a[:-1] for a in ABBREVIATIONS) + r"|[A-Z])\."
SENTENCE_END = r"([.!?])\s+([A-Z\"“‘(])"


def sentences(paragraph: Column) -> Column:
    """Sentences: a full stop, exclamation or question mark, then white space and a capital, quote or bracket; not after an abbreviation or an initial."""
    kept = F.regexp_replace(paragraph, GUARDED, "$1$2\u0001")
    parts = F.split(F.regexp_replace(kept, SENTENCE_END, "$1\u0002$2"), "\u0002")
    return F.filter(F.transform(parts, lambda s: F.trim(F.translate(s, "\u0001", "."))), lambda s: s != "")


def suffix_number(title: Column, pattern: str) -> Column:
    """The number that the pattern's first group finds in a title, or null."""
    return F.regexp_extract(title, pattern, 1).try_cast("int")


def shortened(text: Column, most: int) -> Column:
    """A text cut at a blank so that it has at most so many characters, with an ellipsis if cut."""
    head = F.regexp_replace(F.substring(text, 1, most + 1), r"\s+\S*\z", "")
    return F.when(F.length(text) <= most, text).otherwise(F.concat(head, F.lit("…")))
