"""Annotation records: the model's flat form and the stored nested one, names, addresses and languages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fabula.functions import arc

#: Fields of the eleven arc points in the flat form.
POINTS = tuple(f"t{k:02d}" for k in range(11))


def points_of(flat: Column) -> Column:
    """The arc points of a flat record as an array; null if any is missing."""
    p = F.array(*[flat[n] for n in POINTS])
    return F.when(~F.exists(p, lambda x: x.isNull()), p)


def flat_points(points: Column) -> Column:
    """The inverse: a struct t00 to t10."""
    return F.struct(*[F.get(points, F.lit(k)).alias(n) for k, n in enumerate(POINTS)])


def stored_arc(points: Column, confidence: Column) -> Column:
    """The arc part of a record: points, derived label, flags, and the confidence, capped where a flag is set."""
    a = arc.derive(points)
    return F.struct(points.alias("points"), a["label"].alias("label"), a["fallback"].alias("net_change_fallback"), a["reduced"].alias("reduced_shape"), arc.confidence(confidence, a).alias("confidence"))


def present_terms(judgements: Column, least: float) -> Column:
    """Terms judged present with at least so much confidence; judgements is a map term -> (present, confidence)."""
    return F.array_sort(F.map_keys(F.map_filter(judgements, lambda _, j: j["present"] & (j["confidence"] >= least))))


def title_key(qid: Column, media_type: Column) -> Column:
    return F.concat_ws(":", media_type, qid)


# What stays as it is in the path of an article's address.
KEPT = {"%28": "(", "%29": ")", "%2C": ",", "%27": "'", "%21": "!", "%3A": ":", "%2D": "-", "%2E": ".", "*": "*", "%2F": "/"}


def article_url(title: Column, host: str = "https://en.wikipedia.org/wiki/") -> Column:
    """The address of an article: blanks as underscores, all else percent-encoded but for some punctuation."""
    out = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for code, c in KEPT.items():
        out = F.replace(out, F.lit(code), F.lit(c))
    return F.concat(F.lit(host), out)


def primary_language(languages: Column, named: Sequence[str], in_world: Column) -> Column:
    """For a world title the first language that is not a named one, else the first."""
    other = F.get(F.filter(languages, lambda x: ~x.isin(*named)), F.lit(0))
    return F.when(in_world, F.coalesce(other, F.get(languages, F.lit(0)))).otherwise(F.get(languages, F.lit(0)))


# Rules of remarks in an episode summary, in order, as name and pattern on a sentence.
REMARKS = (
    ("note", r"(?i)^notes?\s*(?::|\s[–—-]\s)"), ("montage_music", r"(?i)^montage music\s*:"), ("timeline", r"(?i)^timeline\s*:"), ("music", r"(?i)^music\s*:"),
    ("guest_star", r"^(?:[Ss]pecial )?[Gg]uest[- ][Ss]tar(?:s|ring)?\b\s*(?::|include\b|(?=[A-Z]))"),
)
# Patterns on a sentence without its parentheses: award bodies and words, first appearances, small roles, names before a verb, a name word.
AWARD_BODY = r"\b(?:Emmy Awards?|(?:Primetime|Daytime) Emmy|Emmy-nominated|Golden Globe|Peabody|BAFTA|(?:Writers|Directors) Guild|TV Guide|ACE Eddie)\b"
AWARD_WORD = r"(?i)\b(?:award|nominat\w*|won|ranked|ranking|list)\b"
FIRST = r"(?i)\bfirst appearance\b|\bfirst episode (?:to|without|with|in which)\b|\bmakes? (?:his|her|their) first appearance\b"
SMALL_ROLE = r"^[A-Z][\w'’.-]*(?: [A-Z][\w'’.-]*)+(?:,[^.]*?)?\s+has an? (?:small|minor|brief|cameo) role as\b"
ALSO_APPEARS, GUEST_STARS = r"^(.+?)\s+also appears?\b(.*)$", r"^(.+?)\s+guest[- ]stars?\b(.*)$"
NAME = r"^(?:[A-Z][\w'’.-]*|and|de|van|von|da|du|le|la)$"


def names_only(names: Column) -> Column:
    """A list of capitalised names, two words at least, and nothing else."""
    words = F.filter(F.split(F.replace(names, F.lit(","), F.lit(" ")), r"\s+"), lambda w: w != "")
    return (F.size(F.filter(words, lambda w: w != "and")) >= 2) & F.get(words, F.lit(0)).rlike("^[A-Z]") & F.forall(words, lambda w: w.rlike(NAME))


def _names_before(bare: Column, pattern: str, role: str) -> Column:
    rest = F.regexp_replace(F.regexp_extract(bare, pattern, 2), r"^[ .]+|[ .]+$", "")
    return bare.rlike(pattern) & names_only(F.regexp_extract(bare, pattern, 1)) & ((rest == "") | rest.rlike(role))


def trivia_rule(sentence: Column) -> Column:
    """The first rule that makes a sentence a remark, or null: it is part of the plot."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(sentence, r"\([^()]*\)", " "), r"\s+", " "))
    late = [
        ("award", bare.rlike(AWARD_BODY) & bare.rlike(AWARD_WORD)), ("first_appearance", bare.rlike(FIRST)), ("small_role", bare.rlike(SMALL_ROLE)),
        ("also_appears", _names_before(bare, ALSO_APPEARS, "^as ")), ("guest_star", _names_before(bare, GUEST_STARS, "^as [A-Z]")),
    ]
    return F.coalesce(*[F.when(sentence.rlike(p), n) for n, p in REMARKS], *[F.when(hit, n) for n, hit in late])


def split_trivia(sentences: Column) -> Column:
    """Struct of the plot sentences and of (rule, text) of the remark, which takes the rest of the paragraph."""
    rules = F.transform(sentences, trivia_rule)
    rule = F.get(F.filter(rules, lambda r: r.isNotNull()), F.lit(0))
    at = F.coalesce(F.array_position(rules, rule), F.lit(0))
    rest = F.when(at > 0, F.array_join(F.slice(sentences, at.cast("int"), F.size(sentences)), " "))
    plot = F.when(at > 0, F.slice(sentences, F.lit(1), (at - 1).cast("int"))).otherwise(sentences)
    return F.struct(plot.alias("plot"), rule.alias("rule"), rest.alias("remark"))


def bindings(body: Column, *names: str) -> Column:
    """Rows of a SPARQL answer in JSON as an array of structs, missing values null."""
    schema = "results struct<bindings: array<struct<" + ", ".join(f"{n}: struct<value: string>" for n in names) + ">>>"
    rows = F.from_json(body, schema)["results"]["bindings"]
    return F.transform(rows, lambda r: F.struct(*[F.nullif(r[n]["value"], F.lit("")).alias(n) for n in names]))
