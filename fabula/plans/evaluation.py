"""Model labels against human ones: agreement, accuracy, calibration, gates.

The labels table holds two binary judgements; a model's labels are rules on the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabula.operators import metrics as M
from fabula.registry import query
from fabula.sources.tables import table

# The model: good if long, shown with a confidence that follows length; it abstains on one source and has no record of texts too short to judge.
_MODEL = """
    SELECT doc_id, lang, source, n_chars, CASE WHEN source = 'src2' THEN '(abstained)' WHEN n_chars > 1200 THEN 'good' ELSE 'poor' END AS label, (50 + n_chars % 50) / 100 AS confidence, lang <> 'en' AS second
    FROM documents WHERE n_chars >= 100"""
_GOLD = "SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS gold, toxic = 1 AS present FROM labels"


def _model(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("source") == "src2", "(abstained)").when(F.col("n_chars") > 1200, "good").otherwise("poor")
    d = table(spark, sf_dir, "documents").where("n_chars >= 100")
    return d.select("doc_id", "lang", "source", "n_chars", label.alias("label"), ((F.lit(50) + F.col("n_chars") % 50) / 100).alias("confidence"), (F.col("lang") != "en").alias("second"))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("gold"), (F.col("toxic") == 1).alias("present"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold outer to model: a missing record is a label of its own, and a miss."""
    g = _gold(spark, sf_dir).join(_model(spark, sf_dir), "doc_id", "left")
    return g.withColumn("label", F.coalesce("label", F.lit("(no model record)")))


_SCORED = f"SELECT g.*, m.lang, m.source, m.confidence, m.second, coalesce(m.label, '(no model record)') AS label FROM ({_GOLD}) g LEFT JOIN ({_MODEL}) m USING (doc_id)"


@query(f"SELECT count(*) AS total, count(*) FILTER (gold = label) AS correct, count(*) FILTER (gold = label) / count(*) AS accuracy, count(*) FILTER (label LIKE '(%') AS misses FROM ({_SCORED})")
def headline_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if(F.col("gold") == F.col("label")).alias("correct"), F.count_if(F.col("label").startswith("(")).alias("misses"))
    return s.withColumn("accuracy", M.ratio(F.col("correct"), F.col("total")))


@query(f"SELECT count(*) FILTER (gold = label OR (second AND gold = 'good')) AS lenient, count(*) AS total FROM ({_SCORED})")
def lenient_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also right where the gold label is among the model's secondary ones."""
    also = F.coalesce(F.col("second") & (F.col("gold") == "good"), F.lit(False))
    return _scored(spark, sf_dir).agg(F.count_if((F.col("gold") == F.col("label")) | also).alias("lenient"), F.count("*").alias("total"))


@query(f"SELECT gold, label, count(*) AS n FROM ({_SCORED}) GROUP BY gold, label")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).groupBy("gold", "label").agg(F.count("*").alias("n"))


@query("""
    WITH c AS (SELECT lang, quality, toxic, count(*) AS c FROM labels JOIN documents USING (doc_id) GROUP BY ALL),
    b AS (SELECT lang, sum(c) AS n, sum(c) FILTER (quality = toxic) AS same FROM c GROUP BY lang),
    x AS (SELECT lang, quality AS l, sum(c) AS a FROM c GROUP BY ALL), y AS (SELECT lang, toxic AS l, sum(c) AS b FROM c GROUP BY ALL),
    m AS (SELECT lang, sum(a * b) AS m FROM x JOIN y USING (lang, l) GROUP BY lang)
    SELECT lang, n::BIGINT AS n, coalesce(same, 0)::BIGINT AS same, round(CASE WHEN n * n <> coalesce(m, 0) THEN (coalesce(same, 0) * n - coalesce(m, 0)) / (n * n - coalesce(m, 0)) END, 9) AS kappa FROM b LEFT JOIN m USING (lang)""")
def cohen_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the two judgements as two raters, by language."""
    p = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return M.kappa(p, "quality", "toxic", "lang").withColumn("kappa", F.round("kappa", 9))


TERMS = ("the", "and", "que", "der", "de")


@query(f"""
    WITH j AS (SELECT t AS term, contains(' ' || lower(text) || ' ', ' ' || t || ' ') AS model, toxic = 1 AS gold FROM labels JOIN documents USING (doc_id), (SELECT unnest({list(TERMS)}) AS t)),
    c AS (SELECT term, count(*) FILTER (gold AND model) AS tp, count(*) FILTER (NOT gold AND model) AS fp, count(*) FILTER (gold AND NOT model) AS fn, count(*) FILTER (NOT gold AND NOT model) AS tn FROM j GROUP BY term),
    r AS (SELECT *, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, (tp + tn) / nullif(tp + fp + fn + tn, 0) AS accuracy FROM c)
    SELECT term, tp, fp, fn, tn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(accuracy, 9) AS accuracy, round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END, 9) AS f1 FROM r""")
def presence_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Presence judgements by term: counts, precision, recall, accuracy and F1."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit(" "), F.lower("text"), F.lit(" ")).alias("text"))
    found = F.array(*[F.struct(F.lit(t).alias("term"), F.contains("text", F.lit(f" {t} ")).alias("model")) for t in TERMS])
    j = table(spark, sf_dir, "labels").join(d, "doc_id").select((F.col("toxic") == 1).alias("gold"), F.inline(found))
    c = M.confusion(j, F.col("gold"), F.col("model"), "term")
    return c.select("term", "tp", "fp", "fn", "tn", *[F.round(x, 9).alias(x) for x in ("precision", "recall", "accuracy", "f1")])


_BAND = "CASE " + " ".join(f"WHEN confidence >= {low} THEN '{name}'" for name, low in M.BANDS if low > 0) + " ELSE '<0.50' END"


@query(f"""
    SELECT band, coalesce(n, 0) AS n, coalesce(correct, 0) AS correct, round(correct / nullif(n, 0), 9) AS accuracy FROM (SELECT unnest({[n for n, _ in M.BANDS]}) AS band)
    LEFT JOIN (SELECT {_BAND} AS band, count(*) AS n, count(*) FILTER (gold = label) AS correct FROM ({_SCORED}) WHERE confidence IS NOT NULL GROUP BY 1) USING (band)""")
def calibration_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _scored(spark, sf_dir).where("confidence is not null").withColumn("right", F.col("gold") == F.col("label"))
    return M.calibration(s, "confidence", "right").withColumn("accuracy", F.round("accuracy", 9))


_SET = "list_distinct(list_filter(string_split(lower({}), ' '), lambda x: x <> ''))"


@query(f"""
    SELECT conv_id, turn, round(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 9) AS jaccard
    FROM (SELECT conv_id, turn, {_SET.format("c.text")} AS a, {_SET.format("b.text")} AS b FROM conversations c JOIN benchmark b ON b.item_id = c.conv_id % 40)""")
def jaccard_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), " "), lambda x: x != ""))
    b = table(spark, sf_dir, "benchmark").select("item_id", words(F.col("text")).alias("b"))
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", words(F.col("text")).alias("a"), (F.col("conv_id") % 40).alias("item_id"))
    return c.join(b, "item_id").select("conv_id", "turn", F.round(M.jaccard(F.col("a"), F.col("b")), 9).alias("jaccard"))


@query("""
    SELECT lang, count(*) FILTER (l.doc_id IS NOT NULL) AS assessed, count(*) FILTER (l.quality = 1) AS same, round(count(*) FILTER (l.quality = 1) / nullif(count(*) FILTER (l.doc_id IS NOT NULL), 0), 9) AS accuracy
    FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY lang""")
def optional_field_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that the gold side lacks is not counted."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    g = d.groupBy("lang").agg(F.count("quality").alias("assessed"), F.count_if(F.col("quality") == 1).alias("same"))
    return g.withColumn("accuracy", F.round(M.ratio(F.col("same"), F.col("assessed")), 9))


@query("""
    SELECT lang, round(avg((n_chars < 500)::INT), 9) AS fallback, round(avg((n_chars BETWEEN 500 AND 1500)::INT), 9) AS reduced, count(*) AS n FROM documents WHERE source <> 'src2' GROUP BY lang""")
def flag_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("source <> 'src2'").groupBy("lang")
    return d.agg(F.round(F.avg((F.col("n_chars") < 500).cast("int")), 9).alias("fallback"), F.round(F.avg(F.col("n_chars").between(500, 1500).cast("int")), 9).alias("reduced"), F.count("*").alias("n"))


@query(f"""
    SELECT count(*) AS matched, count(*) FILTER (label = '(abstained)') AS abstained, round(count(*) FILTER (label = '(abstained)') / nullif(count(*), 0), 9) AS rate,
        list_sort(list(doc_id) FILTER (label = '(abstained)' AND gold = 'good'))[1:20] AS over FROM ({_SCORED}) WHERE label <> '(no model record)'""")
def abstention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of abstentions, and the first twenty titles on which the model should not have."""
    s = _scored(spark, sf_dir).where("label <> '(no model record)'")
    over = s.where("label = '(abstained)' and gold = 'good'").orderBy("doc_id").limit(20).agg(F.array_sort(F.collect_list("doc_id")).alias("over"))
    a = s.agg(F.count("*").alias("matched"), F.count_if(F.col("label") == "(abstained)").alias("abstained"))
    return a.withColumn("rate", F.round(M.ratio(F.col("abstained"), F.col("matched")), 9)).join(F.broadcast(over), F.lit(True))  # one row each


@query("SELECT grade, count(DISTINCT conv_id) AS titles FROM (SELECT conv_id, CASE WHEN contains(text, 'idiot') OR contains(text, 'Que') THEN 'major' WHEN contains(text, 'The') THEN 'mild' END AS grade FROM conversations) WHERE grade IS NOT NULL GROUP BY grade")
def leak_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = F.when(F.col("text").contains("idiot") | F.col("text").contains("Que"), "major").when(F.col("text").contains("The"), "mild")
    return table(spark, sf_dir, "conversations").select("conv_id", grade.alias("grade")).where("grade is not null").groupBy("grade").agg(F.count_distinct("conv_id").alias("titles"))


@query(f"""
    WITH s AS (SELECT * FROM ({_SCORED})), h AS (SELECT count(*) AS n, count(*) FILTER (quality = toxic) AS same FROM labels),
    t AS (SELECT count(*) AS total, count(*) FILTER (gold = label) AS correct, count(*) FILTER (label <> '(no model record)') AS scored, count(*) FILTER (confidence >= 0.95 AND label NOT LIKE '(%') AS shown,
        count(*) FILTER (confidence >= 0.95 AND gold = label) AS shown_correct FROM s)
    SELECT total > 0 AND correct * 100 >= total * 85 AS meets_target, h.n >= 20 AND (correct * 100 * h.n >= (same * 100 - 5 * h.n) * total) AS meets_human,
        CASE WHEN shown < 30 THEN 'insufficient data' WHEN shown_correct * 100 >= shown * 95 THEN 'pass' ELSE 'fail' END AS shown_gate, scored >= 80 AND scored * 100 >= total * 95 AS coverage FROM t, h""")
def exit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release gates in whole numbers: accuracy against a target or against human agreement, accuracy of what is shown, coverage."""
    confident = F.coalesce(F.col("confidence") >= 0.95, F.lit(False))
    t = _scored(spark, sf_dir).agg(
        F.count("*").alias("total"), F.count_if(F.col("gold") == F.col("label")).alias("correct"), F.count_if(F.col("label") != "(no model record)").alias("scored"),
        F.count_if(confident & ~F.col("label").startswith("(")).alias("shown"), F.count_if(confident & (F.col("gold") == F.col("label"))).alias("shown_correct"),
    )
    h = table(spark, sf_dir, "labels").agg(F.count("*").alias("h_n"), F.count_if(F.col("quality") == F.col("toxic")).alias("same"))
    x = t.join(F.broadcast(h), F.lit(True))  # one row each
    c = F.col
    human = (c("h_n") >= M.LEAST_DOUBLE) & (c("correct") * 100 * c("h_n") >= (c("same") * 100 - M.HUMAN_MARGIN * c("h_n")) * c("total"))
    shown = F.when(c("shown") < M.LEAST_SHOWN, "insufficient data").when(M.at_least(c("shown_correct"), c("shown"), M.SHOWN), "pass").otherwise("fail")
    return x.select(M.at_least(c("correct"), c("total"), M.OVERALL).alias("meets_target"), human.alias("meets_human"), shown.alias("shown_gate"), ((c("scored") >= M.LEAST_SCORED) & M.at_least(c("scored"), c("total"), M.COVERAGE)).alias("coverage"))


@query(f"SELECT lang, count(*) AS n, count(*) FILTER (gold = label) AS same FROM ({_SCORED}) WHERE label NOT LIKE '(%' AND gold IS NOT NULL GROUP BY lang")
def blueprint_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only where both sides are annotated."""
    return _gold(spark, sf_dir).join(_model(spark, sf_dir).where(~F.col("label").startswith("(")), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("gold") == F.col("label")).alias("same"))


@query(f"SELECT doc_id, label FROM ({_MODEL}) WHERE label NOT LIKE '(%' AND confidence >= 0.95 AND n_chars >= 500")
def usable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that may be shown: annotated, sure, and not flagged."""
    return _model(spark, sf_dir).where(~F.col("label").startswith("(") & (F.col("confidence") >= 0.95) & (F.col("n_chars") >= 500)).select("doc_id", "label")


_DAY = "SELECT user_id, ts::DATE AS day, event_id, event_type, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY event_id) AS k FROM events"


def _labellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("user_id", "day").orderBy("event_id")
    return table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type").withColumn("k", F.row_number().over(by)).where("k <= 2")


@query(f"SELECT a.user_id, a.day, a.event_type AS first, b.event_type AS second FROM ({_DAY}) a LEFT JOIN ({_DAY}) b ON a.user_id = b.user_id AND a.day = b.day AND b.k = 2 WHERE a.k = 1")
def first_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first two records of a key in load order, side by side."""
    pick = lambda k: F.max(F.when(F.col("k") == k, F.col("event_type")))
    return _labellers(spark, sf_dir).groupBy("user_id", "day").agg(pick(1).alias("first"), pick(2).alias("second"))


@query(f"SELECT count(*) AS n, count(*) FILTER (a.event_type = b.event_type) AS same, round(count(*) FILTER (a.event_type = b.event_type) / nullif(count(*), 0), 9) AS agreement FROM ({_DAY}) a JOIN ({_DAY}) b ON a.user_id = b.user_id AND a.day = b.day AND b.k = 2 WHERE a.k = 1")
def human_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = first_second(spark, sf_dir).where("second is not null").agg(F.count("*").alias("n"), F.count_if(F.col("first") == F.col("second")).alias("same"))
    return p.withColumn("agreement", F.round(M.ratio(F.col("same"), F.col("n")), 9))
