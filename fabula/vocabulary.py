"""Fixed values of the catalogue: quotas, words, headings, labels. Stated as text, in their natural order."""

from __future__ import annotations

# Quotas by decade, and buckets as (name, media type, quota, region).
FILM_DECADES = {"pre-1960": 20, "1960s": 15, "1970s": 25, "1980s": 30, "1990s": 35, "2000s": 35, "2010s": 40, "2020s": 20}
SERIES_DECADES = {"pre-1990": 10, "1990s": 15, "2000s": 25, "2010s": 30, "2020s": 15}
BUCKETS = (
    ("film:english", "movie", 220, "english"), ("film:hindi", "movie", 20, "hindi"), ("film:tamil", "movie", 20, "tamil"), ("film:malayalam", "movie", 15, "malayalam"),
    ("film:telugu", "movie", 5, "telugu"), ("film:korean", "movie", 20, "korean"), ("film:japanese", "movie", 25, "japanese"), ("film:world", "movie", 25, "world"),
    ("tv:english", "tv_series", 95, "english"), ("tv:korean", "tv_series", 15, "korean"), ("tv:anime", "tv_series", 20, "japanese"), ("tv:indian", "tv_series", 8, "indian"), ("tv:world", "tv_series", 12, "world"),
)
DECADE_FLOOR = {"movie": 1960, "tv_series": 1990}

# Genre groups in order, and words that exclude a title.
GENRES = (
    ("animation", ("anime", "animated", "animation")), ("horror", ("horror", "slasher", "zombie")), ("science_fiction", ("science fiction", "sci-fi", "cyberpunk", "dystopian")),
    ("fantasy", ("fantasy", "fairy tale")), ("war", ("war film", "war drama", "war ")), ("western", ("western",)), ("musical", ("musical",)),
    ("crime", ("crime", "gangster", "heist", "police procedural", "legal")), ("thriller", ("thriller", "suspense", "spy")), ("mystery", ("mystery", "detective", "whodunit")),
    ("action", ("action", "superhero", "martial arts", "masala")), ("comedy", ("comedy", "sitcom", "satire", "parody")), ("romance", ("romance", "romantic")), ("adventure", ("adventure",)),
    ("drama", ("drama", "biographical", "melodrama", "coming-of-age")),
)
EXCLUDED_GENRES = (
    "documentary", "concert", "stand-up", "reality", "game show", "talk show", "variety show", "sketch comedy", "anthology", "news", "docudrama series", "nature",
    "factual", "educational", "edutainment", "preschool", "children's music", "talent show", "quiz", "professional wrestling", "sports entertainment", "cooking show",
    "travel documentary", "lifestyle", "makeover", "dating show", "hidden camera", "infotainment", "instructional", "docuseries", "competition television",
)
NON_NARRATIVE = ("Q3109770", "Q41403")


# Plot headings by priority.
FILM_HEADINGS = ("plot", "plot summary", "synopsis", "story", "storyline", "plot overview", "summary", "premise")
SERIES_HEADINGS = ("plot", "synopsis", "plot summary", "series overview", "season synopses", "seasons", "plot overview", "story", "storyline", "summary", "overview", "episodes", "premise")

# Labels.
PLOTS = ("overcoming_the_monster", "rags_to_riches", "the_quest", "voyage_and_return", "comedy", "tragedy", "rebirth", "rebellion_against_the_one", "mystery")
TONES = ("tense", "hopeful", "playful", "warm", "eerie", "melancholic", "cerebral", "bleak", "bittersweet", "triumphant")
# Spoiler level of terms (none 0, mild 1, major 2) where it is not none.
SPOILERS = {
    "mentor_dies": 2, "twist_ending": 1, "unreliable_narrator": 2, "redemption_arc": 1, "pyrrhic_victory": 2, "ambiguous_ending": 1, "bleak": 1, "bittersweet": 1, "triumphant": 1,
    "rags_to_riches": 1, "tragedy": 1, "rebirth": 1, "anti_hero_descent": 1,
}
# Model prices in dollars per million tokens (input, output, cache read).
PRICES = {"large": (4.0, 20.0, 0.20), "medium": (2.0, 10.0, 0.20), "small": (1.0, 5.0, 0.10)}
