"""Which parts of a section tell the story: headings, cue words and the filter over both."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType

# Top headings under which much is not plot, and those whose own lead is taken for a list of episodes.
BROAD = ("episodes", "seasons", "series overview", "overview", "season overview")
LISTS = ("episodes", "seasons")
# Words that make a subheading non-plot, and whole headings that are.
NONPLOT_WORDS = (
    "production", "development", "conception", "filming", "casting", "cast", "crew", "music", "soundtrack", "theme song", "broadcast", "broadcasting", "airing", "ratings",
    "viewership", "reception", "critical response", "accolades", "awards", "nominations", "home media", "home video", "dvd", "blu-ray", "release", "releases", "distribution",
    "syndication", "merchandise", "merchandising", "consumer products", "interpretation", "interpretations", "themes", "theme", "motifs", "symbolism",
    "influences", "inspiration", "inspirations", "derivations", "spin-off", "spin-offs", "spinoff", "spinoffs", "sub-series", "crossover", "crossovers", "backdoor pilot",
    "backdoor pilots", "adaptation", "adaptations", "other media", "cancellation", "episode list", "list of episodes", "missing episodes", "catchphrases", "running gags",
    "trivia", "documentary", "anniversary", "live stage", "stage performances", "controversy", "controversies", "lawsuit", "references", "notes", "see also",
    "external links", "further reading", "bibliography", "webisodes", "minisodes", "prequel shorts", "title sequence", "opening sequence", "opening credits", "revival", "reboot",
)
NONPLOT_HEADINGS = (
    "future", "legacy", "characters", "main characters", "recurring characters", "supporting characters", "format", "episode format", "series format", "chronological order",
    "style", "impact", "cultural impact",
)
# Words of plot headings, and what a number may follow in one.
PLOT_WORDS = "plot|plots|synopsis|synopses|summary|summaries|story|stories|storyline|storylines|plotline|plotlines|premise|arc|arcs|saga|sagas"
NUMBERED = "season|seasons|series|part|parts|book|volume|chapter"
OPENING = "season|series|part|book|volume|chapter|act"
# Cue words of writing about broadcast, production and reception.
CUES = (
    r"air(?:s|ed|ing)", r"air dates?", r"broadcasts?", r"broadcasting", r"premiered", r"premieres?", r"syndicat(?:ed|ion)", r"reruns?", r"time ?slots?", r"nielsen ratings?",
    r"ratings?", r"viewers", r"viewership", r"audiences?", r"streaming", r"dvds?", r"blu-ray", r"home media", r"box set", r"renewed", r"cancell?ed", r"cancellation", r"webisodes",
    r"produced", r"producers?", r"production", r"writers?", r"written", r"wrote", r"scripts?", r"screenwriters?", r"showrunners?", r"series creator", r"directors?", r"directed",
    r"filmed", r"filming", r"casting", r"cast members?", r"actors?", r"actress(?:es)?", r"played by", r"portrayed by", r"guest stars?", r"budget", r"soundtrack", r"theme song",
    r"composer", r"merchandise", r"spin-?offs?", r"pilot episode", r"the show's", r"the programme", r"improvis\w*", r"narrat(?:or|ors|ion)", r"voice-?overs?", r"episode titles?",
    r"critics", r"critical(?:ly)?", r"acclaim(?:ed)?", r"praised", r"reviews?", r"reviewers?", r"emmys?", r"awards?", r"nominat(?:ed|ion|ions)", r"accolades", r"interviews?",
    r"commentary", r"stated", r"according to", r"fans", r"fan theor(?:y|ies)",
)
# Hits a paragraph needs, and in a hundred words; shares at which a part, and the lead of a list, goes; share of words that must stay.
LEAST_HITS, LEAST_IN_100, PART_SHARE, LEAD_SHARE, KEPT_SHARE = 2, 2.5, 0.5, 0.25, 0.5

#: Word borders spelt out, as \b differs between engines.
_NO_WORD_BEFORE, _NO_WORD_AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"


def alternatives(words: tuple[str, ...]) -> str:
    """Words as alternatives of a pattern, longer ones first."""
    return "|".join(sorted(words, key=lambda w: (-len(w), words.index(w))))


def _whole(pattern: str) -> str:
    return f"{_NO_WORD_BEFORE}(?:{pattern}){_NO_WORD_AFTER}"


PLOT_PATTERN = rf"{_whole(PLOT_WORDS)}|{_whole(rf'(?:{NUMBERED})\s+(?:[0-9]+|[ivxlc]+)')}|^(?:{OPENING}){_NO_WORD_AFTER}"


def is_plot_heading(h: Column) -> Column:
    return h.rlike(PLOT_PATTERN)


def nonplot_word(h: Column) -> Column:
    """What makes a normalised heading non-plot: the whole heading, or a word of one that is no plot heading; else null."""
    word = F.regexp_extract(h, f"{_NO_WORD_BEFORE}({alternatives(NONPLOT_WORDS)}){_NO_WORD_AFTER}", 1)
    return F.when(h.isin(*NONPLOT_HEADINGS), h).when(~is_plot_heading(h) & (word != ""), word)


def cue_pattern(cues: tuple[str, ...] = CUES) -> str:
    return "(?i)" + _whole("|".join(cues).replace(r"\w", r"[\p{L}\p{N}_]"))


# The filter itself works on markup, part by part, in Python; the same patterns, with Unicode word borders there.
_PLOT = re.compile(rf"\b(?:{PLOT_WORDS})\b|\b(?:{NUMBERED})\s+(?:[0-9]+|[ivxlc]+)\b|^(?:{OPENING})\b")
_NONPLOT = re.compile(rf"\b({alternatives(NONPLOT_WORDS)})\b")
_CUE = re.compile(rf"\b(?:{'|'.join(CUES)})\b", re.I)
_SPECIALS = re.compile(r"\bspecials?\b")
_WORD = re.compile(r"[^\W_]+(?:['’\-][^\W_]+)*")
_WRAPPED = re.compile(r'<div class="mw-heading(?: mw-heading\d)?"[^>]*>\s*<h([2-6])\b[^>]*>(.*?)</h\1>', re.S)
_TAG, _PARAGRAPH = re.compile(r"<h[2-6]\b"), re.compile(r"<p\b[^>]*>.*?</p>", re.S)


def _words(text: str) -> int:
    return len(_WORD.findall(text))


def _is_about_making(paragraph: str) -> bool:
    n, hits = _words(paragraph), len(_CUE.findall(paragraph))
    return hits >= LEAST_HITS and 100 * hits >= LEAST_IN_100 * n


def _share(text: str) -> float:
    sizes = [(_words(p), _is_about_making(p)) for p in text.split("\n\n")]
    total = sum(n for n, _ in sizes)
    return sum(n for n, making in sizes if making) / total if total else 0.0


@dataclass
class Part:
    """A heading with what follows up to the next one. above: the part that encloses it, or None."""

    level: int
    heading: str
    markup: str
    above: int | None = None
    reason: str | None = None
    trimmed: str | None = None


def parts(html: str) -> list[Part]:
    """The parts of a section; joined, they are the section. What stands before the first heading belongs to the first part."""
    marks = list(_WRAPPED.finditer(html))
    if not marks:
        return [Part(2, "", html)]
    edges = [0, *(m.start() for m in marks[1:]), len(html)]
    out, open_ = [], []  # open_: places of enclosing parts
    for k, m in enumerate(marks):
        level = int(m[1])
        while open_ and out[open_[-1]].level >= level:
            open_.pop()
        name = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", entities.unescape(re.sub(r"<[^>]+>", "", m[2])))).strip().lower().rstrip(":.")
        out.append(Part(level, name, html[edges[k] : edges[k + 1]], open_[-1] if open_ else None))
        open_.append(k)
    return out


@dataclass
class Filtered:
    kind: str
    text: str
    words: int
    words_before: int
    accepted: bool
    reason: str | None = None
    dropped: list[str] = field(default_factory=list)


def _why(part: Part, k: int, all_parts: list[Part], heading: str, plain) -> str | None:
    """Why a part goes, or None. Rules in their order."""
    broad = heading in BROAD
    about = lambda limit: f"content: {s:.0%} about broadcast, production or reception" if (s := _share(plain(part.markup))) >= limit else None
    if k == 0:
        if broad and heading in LISTS and (why := about(LEAD_SHARE)):
            return f"lead of a list, {why}"
        return about(PART_SHARE) if broad and heading not in LISTS else None
    if part.above and all_parts[part.above].reason:
        return f"under {all_parts[part.above].heading!r}"
    if part.heading in NONPLOT_HEADINGS:
        return f"heading: {part.heading!r}"
    plot = bool(_PLOT.search(part.heading))
    if not plot and (m := _NONPLOT.search(part.heading)):
        return f"heading: {m[1]!r}"
    if broad and not plot and not part.above and not _SPECIALS.search(part.heading):
        return "no plot heading"
    if broad and plot:
        for m in _PARAGRAPH.finditer(part.markup):
            text = plain(m[0])
            if _words(text):
                if _is_about_making(text):
                    part.markup, part.trimmed = part.markup[: m.start()] + part.markup[m.end() :], text
                break
    return None if plot and not broad else about(PART_SHARE)


def filtered(html: str, heading: str, media_type: str, plain) -> Filtered:
    """The text of a section's parts that tell the story. plain: markup -> text. A film's section is taken whole."""
    whole = plain(html)
    before = _words(whole)
    if media_type != "tv_series":
        return Filtered("film", whole, before, before, True)
    kind, all_parts = "broad" if heading in BROAD else "plot", parts(html)
    tags, known = len(_TAG.findall(html)), len(all_parts) if all_parts[0].heading else 0
    if tags != known:
        return Filtered(kind, "", 0, before, False, f"markup: {tags} headings, {known} of them wrapped")
    sizes = [_words(plain(p.markup)) for p in all_parts]
    for k, p in enumerate(all_parts):
        p.reason = _why(p, k, all_parts, heading, plain)
    enclosing = {p.above for p in all_parts}
    dropped = [f"{p.heading or heading}: {p.reason}" for k, p in enumerate(all_parts) if p.reason and (sizes[k] or k in enclosing)]
    dropped += [f"{p.heading}: first paragraph" for p in all_parts if not p.reason and p.trimmed]
    text = whole if not dropped and not any(p.reason for p in all_parts) else plain("".join(p.markup for p in all_parts if not p.reason))
    n = _words(text)
    if kind == "broad" and n < KEPT_SHARE * before:
        return Filtered(kind, "", 0, before, False, f"kept {n} of {before} words", dropped)
    return Filtered(kind, text, n, before, True, None, dropped)


RESULT = StructType([
    StructField("kind", StringType()), StructField("text", StringType()), StructField("words", IntegerType()), StructField("words_before", IntegerType()), StructField("accepted", BooleanType()),
    StructField("reason", StringType()), StructField("dropped", ArrayType(StringType())),
])


@pandas_udf(RESULT)
def section_filter(html: pd.Series, heading: pd.Series, media_type: pd.Series) -> pd.DataFrame:
    from fabula.functions.markup import plain

    rows = [filtered(h or "", t or "", m or "", plain) for h, t, m in zip(html, heading, media_type, strict=True)]
    return pd.DataFrame([(r.kind, r.text, r.words, r.words_before, r.accepted, r.reason, r.dropped) for r in rows], columns=RESULT.names)
