"""Headings, paragraphs, sentences and titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.functions import sections as S
from fabula.functions import text as T
from fabula.plans.rates import _WORD, W
from fabula.registry import query
from fabula.sources.tables import table

_HEAD = r"regexp_replace(lower(trim(regexp_replace(regexp_replace(line, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))), '[:.]+$', '')"
#: Headings of all kinds, as pages have them.
_KINDS = (
    "Plot", "Cast and crew", "Season 3", "Legacy", "Notes", "Home media", "Soundtrack", "Main characters", "Season 5: Revival (2016)", "Part II", "Story and characters", "Future Trunks Saga", "Specials",
    "Theme song", "Spin-offs", "Episode list", "Opening credits", "Volume 2", "Act one", "Cultural impact", "Themes", "Synopses", "The broadcasters", "Cast away",
)
#: Lines that look like headings: the part's name with one of those, in markup and with punctuation; then the heading alone.
_KIND_SQL = "[" + ", ".join(f"'{k}'" for k in _KINDS) + f"][p_partkey % {len(_KINDS)} + 1]"
_PART_LINES = f"SELECT p_partkey, '<b>' || p_name || '</b>  ' || {_KIND_SQL} || ':' AS line FROM part"


def _part_lines(spark: SparkSession, sf_dir: str, name: bool = True) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, _KINDS)), (F.col("p_partkey") % len(_KINDS) + 1).cast("int"))
    start = F.concat(F.lit("<b>"), "p_name", F.lit("</b>  ")) if name else F.lit("")
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(start, kind, F.lit(":")).alias("line"))


@query(f"SELECT p_partkey, {_HEAD} AS heading FROM ({_PART_LINES})")
def heading_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_lines(spark, sf_dir).select("p_partkey", T.heading(F.col("line")).alias("heading"))


_EDGE = "[^a-z0-9_]"
_SQL_WORD = f"regexp_extract(' ' || h || ' ', '{_EDGE}({S.alternatives(S.NONPLOT_WORDS)}){_EDGE}', 1)"
_SQL_PLOT = f"regexp_matches(' ' || h || ' ', '{_EDGE}({S.PLOT_WORDS}|({S.NUMBERED})\\s+([0-9]+|[ivxlc]+)){_EDGE}|^ ({S.OPENING}){_EDGE}')"


@query(rf"""
    SELECT kind, count(*) AS n FROM (
        SELECT CASE WHEN h IN {S.NONPLOT_HEADINGS} THEN 'nonplot:' || h WHEN {_SQL_PLOT} THEN 'plot' WHEN {_SQL_WORD} <> '' THEN 'nonplot:' || {_SQL_WORD} ELSE 'open' END AS kind
        FROM (SELECT {_HEAD} AS h FROM ({_PART_LINES}) UNION ALL SELECT {_HEAD} FROM (SELECT {_KIND_SQL} || ':' AS line FROM part))) GROUP BY kind""")
def heading_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of headings with and without a name before them."""
    lines = _part_lines(spark, sf_dir).union(_part_lines(spark, sf_dir, False))
    return lines.select(T.heading_class(T.heading(F.col("line"))).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


#: Common words of this corpus, one by language, that stand for cues: its invented prose has none.
_AS_CUES = (("the", "aired"), ("que", "produced"), ("der", "critics"), ("une", "directed"))
_SQL_CUED = "text"
for _a, _b in _AS_CUES:
    _SQL_CUED = f"replace({_SQL_CUED}, ' {_a} ', ' {_b} ')"
# the engine of the SQL knows no look-around: what may stand beside a cue is consumed, after each word border was doubled
_SQL_HITS = rf"len(regexp_extract_all(' ' || regexp_replace(lower(x), '([^\p{{L}}\p{{N}}_])', '\1\1', 'g') || ' ', '[^\p{{L}}\p{{N}}_](?:{'|'.join(S.CUES).replace(' ', '  ').replace('  ?', '(?:  )?').replace(chr(39), chr(39) * 4).replace('-?', '(?:@@)?').replace('-', '--').replace('@@', '--')})[^\p{{L}}\p{{N}}_]'))"


@query(rf"""
    SELECT doc_id, round(CASE WHEN words > 0 THEN flagged / words ELSE 0.0 END, 9) AS share FROM (
        SELECT doc_id, list_sum(list_transform(p, lambda x: len(regexp_extract_all(x, '{_WORD}')))) AS words,
            list_sum(list_transform(p, lambda x: CASE WHEN {_SQL_HITS} >= 2 AND {_SQL_HITS} * 100 >= len(regexp_extract_all(x, '{_WORD}')) * 2.5 THEN len(regexp_extract_all(x, '{_WORD}')) ELSE 0 END)) AS flagged
        FROM (SELECT doc_id, string_split({_SQL_CUED}, chr(10)) AS p FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)))""")
def nonplot_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of all documents, by line; some common words stand for cues."""
    text = F.coalesce("text", F.lit(""))
    for a, b in _AS_CUES:
        text = F.replace(text, F.lit(f" {a} "), F.lit(f" {b} "))
    return table(spark, sf_dir, "documents").select("doc_id", F.round(T.nonplot_share(text, separator="\n"), 9).alias("share"))


@query(rf"""
    SELECT conv_id, turn, len(s)::BIGINT AS sentences, s[1] AS first, s[-1] AS last FROM (
        SELECT conv_id, turn, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '{T.GUARDED}', '\1\2' || chr(1), 'g'), '{T.SENTENCE_END}', '\1' || chr(2) || '\2', 'g'), chr(2)),
            lambda x: trim(replace(x, chr(1), '.'))), lambda x: x <> '') AS s FROM conversations WHERE text IS NOT NULL)
    WHERE len(s) > 0""")
def sentence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", T.sentences(F.col("text")).alias("s")).where(F.size("s") > 0)
    return s.select("conv_id", "turn", F.size("s").cast("long").alias("sentences"), F.element_at("s", 1).alias("first"), F.element_at("s", -1).alias("last"))


# Rules of remarks in order: name and pattern on a lower-cased sentence.
REMARKS = (("note", "^(note|la|le)($|[^a-z])"), ("music", "^(der|the)($|[^a-z])"), ("timeline", "^(que|of)($|[^a-z])"), ("first_appearance", "(^|[^a-z])that($|[^a-z])"))
_REMARK = "CASE " + " ".join(f"WHEN regexp_matches(lower(s), '{p}') THEN '{n}'" for n, p in REMARKS) + " END"


def _remark(s):
    return F.coalesce(*[F.when(F.lower(s).rlike(p), n) for n, p in REMARKS])


@query(rf"""
    WITH s AS (SELECT conv_id, turn, unnest(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \t\r\n]+', '\1' || chr(2), 'g'), chr(2)), lambda x: trim(x)), lambda x: x <> '')) AS s,
            generate_subscripts(list_filter(list_transform(string_split(regexp_replace(text, '([.!?])[ \t\r\n]+', '\1' || chr(2), 'g'), chr(2)), lambda x: trim(x)), lambda x: x <> ''), 1) AS k
        FROM conversations WHERE text IS NOT NULL),
    f AS (SELECT conv_id, turn, k, {_REMARK} AS rule FROM s)
    SELECT rule, count(*) AS items, sum(rest)::BIGINT AS sentences FROM (
        SELECT conv_id, turn, arg_min(rule, k) FILTER (rule IS NOT NULL) AS rule, max(k) - min(k) FILTER (rule IS NOT NULL) + 1 AS rest FROM f GROUP BY conv_id, turn)
    WHERE rule IS NOT NULL GROUP BY rule""")
def trivia_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first remark of a text takes all that follows it; items and sentences by rule."""
    t = table(spark, sf_dir, "conversations").where("text is not null")
    s = F.filter(F.transform(F.split(F.regexp_replace("text", r"([.!?])[ \t\r\n]+", "$1\u0002"), "\u0002"), F.trim), lambda x: x != "")
    rules = t.select(F.transform(s, _remark).alias("rules"))
    first = F.get(F.filter("rules", lambda r: r.isNotNull()), F.lit(0))
    rest = F.size("rules") - F.array_position(F.col("rules"), first) + 1
    return rules.select(first.alias("rule"), rest.alias("rest")).where("rule is not null").groupBy("rule").agg(F.count("*").alias("items"), F.sum("rest").cast("long").alias("sentences"))


@query(r"""
    SELECT conv_id, turn, '[' || role || ' ' || (turn + 1) || CASE WHEN length(text) > 0 THEN ': "' || (CASE WHEN length(text) <= 40 THEN text ELSE regexp_replace(substr(text, 1, 41), '\s+\S*\z', '') || '…' END) || '"' ELSE '' END || ']' AS marker
    FROM conversations WHERE text IS NOT NULL""")
def episode_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker with number and title, the title cut at a blank; a number alone where there is no title."""
    title = F.when(F.length("text") > 0, F.concat(F.lit(': "'), T.shortened(F.col("text"), 40), F.lit('"'))).otherwise("")
    return table(spark, sf_dir, "conversations").where("text is not null").select("conv_id", "turn", F.concat(F.lit("["), "role", F.lit(" "), (F.col("turn") + 1).cast("string"), title, F.lit("]")).alias("marker"))


@query(r"SELECT page_id, try_cast(regexp_extract(url, '/([0-9]{1,9})(?:\.html|/)?(?:[?#].*)?$', 1) AS INT) AS number FROM pages")
def suffix_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.suffix_number(F.col("url"), r"/([0-9]{1,9})(?:\.html|/)?(?:[?#].*)?$").alias("number"))


@query("""
    SELECT p_partkey, unnest([p_name || ' (season ' || n || ')', p_name || ' season ' || n, p_name || ' series ' || n]) AS guess FROM part, range(1, 4) AS t(n)
    UNION ALL SELECT p_partkey, 'List of ' || p_name || ' episodes' FROM part""")
def title_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles under which seasons of a series may have a page."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.explode(F.array(*map(F.lit, "123"))).alias("n"))
    forms = F.array(F.concat("p_name", F.lit(" (season "), "n", F.lit(")")), F.concat("p_name", F.lit(" season "), "n"), F.concat("p_name", F.lit(" series "), "n"))
    lists = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("List of "), "p_name", F.lit(" episodes")).alias("guess"))
    return p.select("p_partkey", F.explode(forms).alias("guess")).unionAll(lists)


@query(r"""
    SELECT page_id, list_filter(list_reverse(string_split(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', ''), '/')), lambda x: regexp_matches(x, '^(en|fr|de|es)$|example'))[1] AS nearest FROM pages""")
def nearest_heading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the steps of a path, the last that names what is sought."""
    path = F.split(F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[?#].*$", ""), "/")
    return table(spark, sf_dir, "pages").select("page_id", F.get(F.filter(F.reverse(path), lambda x: x.rlike("^(en|fr|de|es)$|example")), F.lit(0)).alias("nearest"))


@query(r"""
    SELECT page_id, host, kind, start, row_number() OVER (PARTITION BY host ORDER BY kind, start, page_id) AS place FROM (
        SELECT page_id, regexp_extract(url, '//([^/]*)', 1) AS host, CASE WHEN url LIKE '%.html%' THEN 0 WHEN url LIKE '%?%' THEN 1 WHEN url LIKE '%#%' THEN 2 ELSE 3 END AS kind, coalesce(try_cast(regexp_extract(url, '/([0-9]{1,9})', 1) AS INT), 0) AS start FROM pages)""")
def list_page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of a host in order of kind of suffix, then number. Hosts are ordered each by itself; counts by kind and number come first, so that a large host's places need no one task."""
    kind = F.when(F.col("url").contains(".html"), 0).when(F.col("url").contains("?"), 1).when(F.col("url").contains("#"), 2).otherwise(3)
    start = F.coalesce(F.regexp_extract("url", "/([0-9]{1,9})", 1).try_cast("int"), F.lit(0))
    p = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "//([^/]*)", 1).alias("host"), kind.alias("kind"), start.alias("start"))
    steps = p.groupBy("host", "kind", "start").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("host").orderBy("kind", "start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = steps.select("host", "kind", "start", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("host", "kind", "start").orderBy("page_id"))
    return p.join(steps, ["host", "kind", "start"]).select("page_id", "host", "kind", "start", (F.col("before") + inside).alias("place"))


@query(f"SELECT doc_id, {W} AS words, sha256(coalesce(text, '')) AS sha, {W} >= 150 AND length(coalesce(text, '')) = n_chars AS text_ok FROM documents")
def text_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recomputed hash, word count and length of each text against what is stored."""
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select("doc_id", T.word_count(text).alias("words"), T.sha256(text).alias("sha"), ((T.word_count(text) >= 150) & (F.length(text) == F.col("n_chars"))).alias("text_ok"))


