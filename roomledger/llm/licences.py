"""Licence scan: a sparse word n-gram logistic regression over paragraphs, in DataFrame operations only.

Training. The labelled table (``licence_examples``) gives paragraphs of licence families, of other
licence talk ("unknown") and of ordinary text ("none"), the latter joined by a bounded hash sample of
the corpus' own paragraphs. Features are word unigrams and bigrams of the licence paragraphs that the
ordinary ones do not have. The multinomial regression is Spark ML's, fitted on one half of the table
to calibrate, on all of it to predict: the least probability at which a family counts is the smallest
on a grid that keeps the other half's unknown and ordinary paragraphs out of every family.

Scan. Every paragraph of every text is cut to words, its unigrams and bigrams are exploded and
joined, by hash, with the small broadcast table of known n-grams; only matches go on, so the shuffle
is in proportion to licence-like text. A paragraph ends at a blank line, so a notice may be wrapped over lines;
its lines are taken together. Sums of weights per paragraph give the softmax.
A paragraph that is predicted to be of a family is confirmed by comparing it with the templates: at least
``CONTAINED`` of a template's distinct bigrams must occur in it, and the words that decide between the family
and its relatives (name, version, variant: ``DECIDING``). Several notices in one paragraph are each confirmed by
their own templates. Paragraphs with licence features that are confirmed for no family, and are not ordinary by
the model, count as unknown.

Defined results: null and empty texts have no notices; repeated rows (same id and text) each give a
row with the same figures; a null doc_id is kept; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.llm.common import id_text
from roomledger.llm.licence_examples import DECIDING, ORDINARY, SURROUNDINGS, TEMPLATES, UNKNOWN
from roomledger.session import stage

FAMILIES = tuple(TEMPLATES)
CLASSES = (*FAMILIES, "unknown", "none")
CONTAINED = 0.8
SAMPLED_PARAGRAPHS = 2000  # ordinary paragraphs from the corpus, at most
LONGEST_SAMPLED = 2000  # characters; longer paragraphs are not used for fitting
GRID = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


BLANK_LINE = "\n[ \t\r]*\n\\s*"


def paragraphs(text: Column) -> Column:
    return F.split(text, BLANK_LINE)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def pairs(tokens: Column, combine) -> Column:
    """``combine`` of each token and the next one."""
    after = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.slice(F.zip_with(tokens, after, combine), 1, F.greatest(F.size(tokens) - 1, F.lit(0)))


def bigrams(tokens: Column) -> Column:
    return pairs(tokens, lambda a, b: F.concat_ws(" ", a, b))


def hashed(gram: Column) -> Column:
    """The number that stands for an n-gram given as text."""
    parts = F.split(gram, " ")
    return F.when(F.size(parts) == 2, F.xxhash64(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(F.xxhash64(gram))


def hashed_grams(tokens: Column) -> Column:
    """The numbers of all unigrams and bigrams, without making the bigrams' strings."""
    return F.concat(F.transform(tokens, lambda w: F.xxhash64(w)), pairs(tokens, lambda a, b: F.xxhash64(a, b)))


def grams(tokens: Column) -> Column:
    return F.concat(tokens, bigrams(tokens))


def examples(spark: SparkSession) -> DataFrame:
    """label, half, text: the labelled table; templates are surrounded by other words."""
    rows = []
    for family, templates in TEMPLATES.items():
        for template in templates:
            rows += [(family, i % 2, f"{before} {template} {after}") for i, (before, after) in enumerate(SURROUNDINGS)]
    for label, texts in (("unknown", UNKNOWN), ("none", ORDINARY)):
        rows += [(label, i % 2, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "label string, half int, text string")


def ordinary_sample(docs: DataFrame) -> DataFrame:
    """A bounded sample of the corpus' lines without the word stem of licences: those of the smallest hashes."""
    lines = id_text(docs, spread=False).select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    fit = (F.col("text") != "") & (F.length("text") <= LONGEST_SAMPLED) & ~F.lower("text").rlike("licen|copyright")
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(997))
    picked = lines.filter(fit & (share == 0)).select("text").distinct().orderBy(F.xxhash64("text"), "text").limit(SAMPLED_PARAGRAPHS)
    return picked.select(F.lit("none").alias("label"), F.pmod(F.hash("text"), F.lit(2)).alias("half"), "text")


def fit(table: DataFrame, vocabulary: CountVectorizerModel) -> dict[str, list[float]]:
    """n-gram -> weight per class, with the constant under the empty string."""
    vectors = vocabulary.transform(table)
    order = F.element_at(F.create_map(*[x for i, c in enumerate(CLASSES) for x in (F.lit(c), F.lit(float(i)))]), F.col("label"))
    regression = LogisticRegression(
        featuresCol="features", labelCol="y", family="multinomial", regParam=0.002, maxIter=40, standardization=False
    )
    model = regression.fit(vectors.withColumn("y", order).coalesce(1))
    rows = model.coefficientMatrix.toArray().tolist()
    missing = [[0.0] * len(rows[0])] * (len(CLASSES) - len(rows))
    weights = {gram: [row[i] for row in rows + missing] for i, gram in enumerate(vocabulary.vocabulary)}
    constants = model.interceptVector.toArray().tolist()
    weights[""] = constants + [-30.0] * (len(CLASSES) - len(constants))
    return weights


class Model:
    """Weights and threshold; ``table`` gives the small join table of all known n-grams."""

    def __init__(self, weights: dict[str, list[float]], threshold: float):
        self.weights, self.threshold = weights, threshold

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(gram, weights) for gram, weights in self.weights.items() if gram]
        known = spark.createDataFrame(rows, "gram string, weights array<double>")
        template_grams = templates(spark).select("gram").union(deciding(spark).select("gram")).distinct()
        return known.join(template_grams, "gram", "full").select(hashed(F.col("gram")).alias("gram"), "weights").coalesce(1)


def templates(spark: SparkSession) -> DataFrame:
    """family, template, size, gram: the distinct bigrams of each template."""
    rows = [(family, i, text) for family, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "family string, template int, text string")
    table = table.withColumn("grams", F.array_distinct(bigrams(words(F.col("text")))))
    return table.select("family", "template", F.size("grams").alias("size"), F.explode("grams").alias("gram"))


def deciding(spark: SparkSession) -> DataFrame:
    """family, part, gram: one pair of every part must be there."""
    rows = [(family, i, pair) for family, parts in DECIDING.items() for i, part in enumerate(parts) for pair in part]
    return spark.createDataFrame(rows, "family string, part int, gram string")


def softmax(scores: Column) -> Column:
    powers = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    total = F.aggregate(powers, F.lit(0.0), lambda a, b: a + b)
    return F.transform(powers, lambda p: p / total)


def train(docs: DataFrame) -> Model:
    spark = docs.sparkSession
    table = examples(spark).unionByName(ordinary_sample(docs)).withColumn("grams", F.array_distinct(grams(words(F.col("text")))))
    table = stage(table.select("label", "half", "grams"), "licence-examples")  # both fits see the same rows, read once
    ordinary = table.filter("label = 'none'").select(F.explode("grams").alias("gram")).distinct()
    licence = table.filter("label <> 'none'").select(F.explode("grams").alias("gram")).distinct()
    names = sorted(row.gram for row in licence.join(ordinary, "gram", "left_anti").collect())  # bounded by the examples
    vocabulary = CountVectorizerModel.from_vocabulary(names, inputCol="grams", outputCol="features", minTF=1.0)
    vocabulary = vocabulary.setBinary(True)
    weights = fit(table.filter("half = 0"), vocabulary)
    other = table.filter("half = 1 AND label IN ('unknown', 'none')").select("grams").collect()  # bounded by the sample

    def best_family(present: list[str]) -> float:
        scores = [c + sum(weights[g][i] for g in present if g in weights) for i, c in enumerate(weights[""])]
        total = sum(math.exp(s - max(scores)) for s in scores)
        return max(math.exp(s - max(scores)) / total for s in scores[: len(FAMILIES)])

    highest = max((best_family(row.grams) for row in other), default=0.0)
    threshold = next((g for g in GRID if g > highest), GRID[-1])
    return Model(fit(table, vocabulary), threshold)


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per licence-like paragraph: key1, key2, paragraph, family, probability, similarity, confirmed."""
    spark = docs.sparkSession
    texts = id_text(docs)
    keyed = texts.select(*keys(), F.posexplode(paragraphs(F.col("text"))).alias("paragraph", "body"))
    tokens = keyed.select("key1", "key2", "paragraph", words(F.col("body")).alias("tokens"))
    found = tokens.select("key1", "key2", "paragraph", F.explode(hashed_grams(F.col("tokens"))).alias("gram"))
    known = F.broadcast(model.table(spark))  # bounded by the examples
    present = found.join(known.select("gram"), "gram").distinct()
    weighted = present.join(known, "gram")
    sums = [F.sum(F.get("weights", F.lit(i))) + constant for i, constant in enumerate(model.weights[""])]
    scored = weighted.groupBy("key1", "key2", "paragraph").agg(
        F.count("weights").alias("features"), F.array(*sums).alias("scores")
    )
    scored = scored.filter("features > 0").withColumn("p", softmax(F.col("scores")))
    family = F.get(F.array(*map(F.lit, FAMILIES)), F.array_position(F.slice("p", 1, len(FAMILIES)), best(F.col("p"))).cast("int") - 1)
    unit = ["key1", "key2", "paragraph"]
    scored = scored.select(*unit, family.alias("predicted"), best(F.col("p")).alias("probability"), F.element_at("p", -1).alias("none"))
    own = F.broadcast(templates(spark).withColumn("gram", hashed(F.col("gram"))))  # bounded by the templates
    hits = present.join(own, "gram").groupBy(*unit, "family", "template")
    alike = hits.agg((F.count(F.lit(1)) / F.first("size")).alias("similarity"))
    alike = alike.groupBy(*unit, "family").agg(F.max("similarity").alias("similarity")).where(F.col("similarity") >= CONTAINED)
    decides = F.broadcast(deciding(spark).withColumn("gram", hashed(F.col("gram"))))  # bounded by the table
    needed = {name: len(parts) for name, parts in DECIDING.items()}
    parts = F.element_at(F.create_map(*[x for name, n in needed.items() for x in (F.lit(name), F.lit(n))]), F.col("family"))
    decided = present.join(decides, "gram").groupBy(*unit, "family").agg(F.count_distinct("part").alias("found")).where(F.col("found") == parts)
    confirmed = alike.join(decided.select(*unit, "family"), [*unit, "family"])
    both = scored.join(confirmed, unit, "left")
    agreed = (F.col("probability") >= model.threshold) & F.col("similarity").isNotNull()
    return both.select(
        *unit,
        F.coalesce("family", "predicted").alias("family"),
        "probability",
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
        "none",
        agreed.alias("confirmed"),
    ).filter(F.col("confirmed") | (F.col("none") < 0.5))


def best(p: Column) -> Column:
    return F.array_max(F.slice(p, 1, len(FAMILIES)))


def keys() -> tuple[Column, Column]:
    """128 bits that stand for a row's id and whole text, so that texts need not be shuffled."""
    return F.xxhash64("doc_id", "text").alias("key1"), F.xxhash64("text", "doc_id", F.lit(1)).alias("key2")


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_confirmed, n_unknown, families, licence (the first confirmed, else unknown or none)."""
    notices = scan(docs, train(docs))
    by_document = notices.groupBy("key1", "key2").agg(
        F.count_distinct(F.when(F.col("confirmed"), F.col("paragraph"))).alias("n_confirmed"),
        F.count_distinct(F.when(~F.col("confirmed"), F.col("paragraph"))).alias("n_unknown"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        F.min_by("family", F.when(F.col("confirmed"), F.struct("paragraph", -F.col("similarity"), "family"))).alias("first"),
        F.max(F.when(F.col("confirmed"), F.col("probability"))).alias("probability"),
    )
    rows = id_text(docs, spread=False).select("doc_id", *keys(), F.size(paragraphs(F.col("text"))).cast("long").alias("n_paragraphs"))
    none = F.when(F.col("n_unknown") > 0, "unknown").otherwise("none")
    return rows.join(by_document, ["key1", "key2"], "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("n_confirmed", F.lit(0)).cast("long").alias("n_confirmed"),
        F.coalesce("n_unknown", F.lit(0)).cast("long").alias("n_unknown"),
        F.coalesce("families", F.lit("")).alias("families"),
        F.when(F.col("n_confirmed") > 0, F.col("first")).otherwise(none).alias("licence"),
        F.round("probability", 6).alias("probability"),
    )
