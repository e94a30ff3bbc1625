"""Licence scan: a trained paragraph classifier, in DataFrame operations and
Spark's JVM machine learning only.

Paragraphs (lines) are sparse sets of word uni- and bigrams, of those that occur
in the templates. A multinomial logistic regression with an L1 penalty learns
the licence families from their templates, each in many variants with words
left out, and the class ``unknown`` from one half of all the input's paragraphs
that are unlike any template (by a hash). On the other half the least
probability of any licence is calibrated: at most ``FALSE_SHARE`` of it may pass.
Paragraphs of the same terms are one row with their number; together those of
``unknown`` weigh as much as so many templates, however large the input. The two most probable families are compared with the paragraph by their
templates, as shares of either one's bigrams, and the more alike is predicted.
It is confirmed if it is alike enough and more so than all other families;
otherwise (a sentence that several licences share word for word, say) the
family is ``unknown``. The version is the number that the notice names.

A notice may run over line ends. Each line is also read on to the next line
without words, ``REACH`` words at most (twice the longest template). Where this
holds a greater share of a template than the line and than what follows it, the
words from the template's first to its last bigram are predicted and confirmed
as well; the row of the line in which they begin then bears that family.

Nulls: a null text has no paragraphs; a null doc_id is kept. Equal rows are
scanned each. A table without text gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaweave.llm.common import query, table, written
from taxaweave.llm.licence_texts import templates as templates_of

#: Variants per template; what all paragraphs for ``unknown`` weigh at most, in
#: variants; share of words left out of a variant, in tenths.
VARIANTS = 24
UNKNOWN_WEIGHT = 4_500
LEFT_OUT = 2
FALSE_SHARE = 0.001
LEAST_PROBABILITY = 0.5
#: Steps of the calibrated probability.
STEPS = 100_000
#: Share of a template's bigrams of which a paragraph for ``unknown`` holds less.
UNLIKE = 0.3
#: Share of a template's bigrams that a paragraph must hold, or of its own that
#: a template must hold; and the least number of them in either case.
CONFIRMED = 0.5
LEAST_HELD, LEAST_OWN = 2, 4
UNKNOWN = "unknown"
#: What stands before a version, in words.
VERSION = r"\b(?:version|v|license|gpl|mpl|cc0|international|attribution|sharealike|noncommercial|noderivatives|by|sa|nc|nd) (\d(?: \d\b)?)(?!\d)"

TEMPLATES = templates_of()
FAMILIES = [UNKNOWN, *TEMPLATES]
#: Words that are read on behind a line's end, and back before it.
REACH = 2 * max(len(t.split()) for ts in TEMPLATES.values() for t in ts)


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(w: Column) -> Column:
    return F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w), F.lit(1))), lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit("$"))))


def terms(w: Column, vocabulary: list[str]) -> Column:
    """The distinct terms of a word array that are in the vocabulary."""
    single = sorted({t for t in vocabulary if " " not in t})
    double = sorted({t for t in vocabulary if " " in t})
    known = F.transform(w, lambda x: F.when(x.isin(single), x))
    pair = lambda a, b: F.when(a.isNotNull(), F.concat_ws(" ", a, F.coalesce(b, F.lit("$"))))
    pairs = lambda k: F.zip_with(k, F.slice(k, F.lit(2), F.greatest(F.size(k), F.lit(1))), pair)
    return let(known, lambda k: F.array_distinct(F.concat(F.array_compact(k), F.filter(pairs(k), lambda t: t.isin(double)))))


def vocabulary(spark: SparkSession) -> list[str]:
    """All uni- and bigrams of the templates (fixed text)."""
    own = F.explode(F.concat("words", bigrams(F.col("words"))))
    return [r["t"] for r in templates(spark).select(own.alias("t")).distinct().orderBy("t").collect()]


def templates(spark: SparkSession) -> DataFrame:
    """family, label, words; fixed rows."""
    rows = [(f, float(FAMILIES.index(f)), t) for f, ts in TEMPLATES.items() for t in ts]
    return spark.createDataFrame(rows, "family string, label double, line string").withColumn("words", words(F.col("line")))


def known_bigrams(spark: SparkSession) -> DataFrame:
    """A row per family: its templates' bigram sets."""
    return templates(spark).groupBy("family").agg(F.collect_list(F.array_distinct(bigrams(F.col("words")))).alias("held"))  # fixed rows


def unlike(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """terms, learn, calibrate: how many paragraphs unlike all templates have these
    terms, in either half by a hash of doc_id and paragraph number. Every
    paragraph with words is counted."""
    spark = docs.sparkSession
    own = templates(spark).select("line", F.array_distinct(bigrams(F.col("words"))).alias("own"))
    held = own.select("line", F.size("own").alias("n"), F.explode("own").alias("pair"))
    half = F.pmod(F.xxhash64("doc_id", "paragraph"), F.lit(2))
    # built inside the generator, so that no filter or grouping repeats it
    parts = lambda w: F.struct(F.array_sort(terms(w, vocabulary)).alias("terms"), F.concat(F.element_at(w, -1), F.lit(" $")).alias("end"))
    ended = lambda p: F.struct(p["terms"].alias("terms"), F.when(F.array_contains(p["terms"], p["end"]), p["end"]).alias("end"))
    split = F.transform(F.split("text", "\n"), lambda line: let(words(line), lambda w: F.when(F.size(w) > 0, let(parts(w), ended))))
    each = docs.select("doc_id", F.posexplode(split).alias("paragraph", "p")).where("p is not null")
    sets = each.groupBy("p.terms", "p.end").agg(F.sum(1 - half).alias("learn"), F.sum(half).alias("calibrate"))
    # a term ``word $`` also stands before unknown words: of these only the paragraph's end is a bigram
    pairs = F.filter("terms", lambda t: t.contains(" ") & (~t.endswith(" $") | t.eqNullSafe(F.col("end"))))
    sets = written(sets, "paragraphs").withColumn("pairs", pairs)
    # only templates of which so many bigrams can hold the share
    of = sets.select("pairs").distinct().select("pairs", F.size("pairs").alias("size"), F.explode("pairs").alias("pair"))
    shared = of.join(F.broadcast(held), (of["pair"] == held["pair"]) & (F.col("size") / F.col("n") >= UNLIKE))  # the templates' bigrams
    like = shared.groupBy("pairs", "line", "n").agg(F.count("*").alias("k")).where(F.col("k") / F.col("n") >= UNLIKE)
    far = sets.join(like.select("pairs"), "pairs", "left_anti")
    return far.groupBy("terms").agg(F.sum("learn").alias("learn"), F.sum("calibrate").alias("calibrate"))


def exceeded(scored: DataFrame, share: float) -> float:
    """The least ``p`` (0 to 1, rounded up to ``STEPS``) that at most ``share`` of
    the rows, each ``n`` times, exceed."""
    steps = scored.groupBy(F.ceil(F.col("p") * STEPS).alias("step")).agg(F.sum("n").alias("n")).orderBy(F.desc("step")).collect()  # a row per step
    total, above = sum(r["n"] for r in steps), 0
    for r in steps:
        above += r["n"]
        if above > share * total:
            return r["step"] / STEPS
    return 0.0


def fit(docs: DataFrame) -> tuple[PipelineModel, float]:
    """The classifier and its calibrated least probability."""
    spark = docs.sparkSession
    terms_ = vocabulary(spark)
    other = written(unlike(docs, terms_), "unlike")
    total = other.agg(F.sum("learn")).first()[0] or 0
    stays = lambda w, i: F.pmod(F.xxhash64(F.concat_ws(" ", "line", i, "seed")), F.lit(10)) >= F.when(F.col("seed") == 0, 0).otherwise(LEFT_OUT)
    variants = templates(spark).join(spark.range(VARIANTS).withColumnRenamed("id", "seed")).select("label", F.filter("words", stays).alias("words"))
    known = variants.select("label", terms(F.col("words"), terms_).alias("terms"), F.lit(1.0).alias("weight"))
    weight = F.col("learn") * min(1.0, UNKNOWN_WEIGHT / max(1, total))
    rows = known.unionByName(other.where("learn > 0").select(F.lit(0.0).alias("label"), "terms", weight.alias("weight")))
    rows = written(rows.repartition("terms").sortWithinPartitions("label", "terms"), "lessons")
    counts = CountVectorizerModel.from_vocabulary(terms_, "terms", "features")
    counts = counts.setBinary(True)
    learn = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=40, standardization=False, weightCol="weight")
    model = Pipeline(stages=[counts, learn]).fit(rows)
    best = 1 - vector_to_array("probability")[0]
    scored = model.transform(other.where("calibrate > 0")).select(best.alias("p"), F.col("calibrate").alias("n"))
    return model, max(LEAST_PROBABILITY, exceeded(scored, FALSE_SHARE))


def shares(pairs: Column, held: Column) -> Column:
    """Per template the share of its bigrams that are among ``pairs``."""
    n = lambda t: F.size(F.array_intersect(t, pairs))
    return F.transform(held, lambda t: let(n(t), lambda k: F.when(k >= LEAST_HELD, k / F.size(t)).otherwise(0.0)))


def contained(own: Column, held: Column) -> Column:
    """The largest share of a template's bigrams among a paragraph's, or of the
    paragraph's among a template's, and how many these are."""
    either = lambda t, k: F.when(k >= LEAST_OWN, k / F.least(F.size(own), F.size(t))).when(k >= LEAST_HELD, k / F.size(t)).otherwise(0.0)
    return F.array_max(F.transform(held, lambda t: let(F.size(F.array_intersect(own, t)), lambda k: F.struct(either(t, k).alias("share"), k.alias("n")))))


def version(w: Column) -> Column:
    """The number that a notice names as its licence's version, or null."""
    number = F.regexp_extract(F.array_join(w, " "), VERSION, 1)
    return F.when(number != "", F.translate(number, " ", "."))


def read_on(docs: DataFrame, known: list[list[str]]) -> DataFrame:
    """doc_id, paragraph, line, words, over: the words of a notice that begins
    in the line and runs over its end (null where there is none). The search is
    inside the generator, so that no filter or projection repeats it."""
    lines = F.split("text", "\n")
    every = sorted({t for ts in known for t in ts})

    def after(w: Column, i: Column) -> Column:
        cut = lambda n, blank: F.when(blank > 0, F.slice(n, F.lit(1), (blank - 1).cast("int"))).otherwise(n)
        return let(F.slice(w, i + 2, F.lit(REACH)), lambda n: F.slice(F.flatten(cut(n, F.array_position(F.transform(n, F.size), 0))), 1, REACH))

    def unit(w: Column, line: Column, i: Column) -> Column:
        own = F.get(w, i)
        last = F.concat(own, F.slice(F.get(w, i + 1), 1, 1))
        more = (F.size(own) > 0) & (F.size(F.get(w, i + 1)) > 0)
        begun = F.when(more, F.exists(bigrams(last), lambda t: t.isin(every)))
        return F.struct(line.alias("line"), own.alias("words"), F.when(begun, over_end(own, after(w, i), known, every)).alias("over"))

    units = let(F.transform(lines, words), lambda w: F.transform(lines, lambda line, i: unit(w, line, i)))
    return docs.select("doc_id", F.posexplode(units).alias("paragraph", "u")).select("doc_id", "paragraph", "u.line", "u.words", "u.over")


def over_end(own: Column, after: Column, known: list[list[str]], every: list[str]) -> Column:
    """Of a line's words and those after it: from the first to the last bigram of
    the template of which they hold the most, if more than either alone.
    ``known`` are the templates' bigrams, the shortest first."""
    held = F.array(*[F.array(*map(F.lit, t)) for t in known])
    # so many bigrams can hold the share of CONFIRMED of the shortest templates only
    able = [sum(max(LEAST_HELD, CONFIRMED * len(t)) <= n for t in known) for n in range(len(known[-1]) + 1)]
    first = lambda p: F.slice(held, F.lit(1), F.get(F.array(*map(F.lit, able)), F.least(F.size(p), F.lit(len(able) - 1))))
    # who holds CONFIRMED of a template holds one at least of its longest, one more than may be missing
    telling = sorted({p for t in known for p in sorted(t, key=len)[-(int((1 - CONFIRMED) * len(t)) + 1) :]})
    worth = lambda p: (F.size(p) >= LEAST_HELD) & F.exists(p, lambda t: t.isin(telling))
    share = lambda w: let(F.array_distinct(F.filter(bigrams(w), lambda t: t.isin(every))), lambda p: F.when(worth(p), shares(p, first(p))))
    tail = F.slice(own, F.greatest(F.lit(1), F.size(own) - REACH + 1), F.lit(REACH))
    at = lambda w, t: F.filter(F.transform(bigrams(w), lambda p, i: F.when(F.array_contains(t, p), i)), lambda i: i.isNotNull())

    def gained(g: Column, rest: Column) -> Column:
        zero = F.array_repeat(F.lit(0.0), len(known))
        most = lambda x, y: F.when((x >= CONFIRMED) & (x > F.coalesce(y, F.lit(0.0))), x).otherwise(0.0)
        beyond = F.zip_with(F.coalesce(share(own), zero), F.coalesce(share(rest), zero), lambda x, y: F.greatest(x, y))  # nulls are passed over
        best = lambda m: F.when(F.array_max(m) > 0, F.get(held, F.array_position(m, F.array_max(m)).cast("int") - 1))
        return let(F.zip_with(g, beyond, most), best)

    def stretch(w: Column, rest: Column) -> Column:
        cut = lambda a: F.slice(w, F.array_min(a) + 1, F.array_max(a) - F.array_min(a) + 2)
        best = let(share(w), lambda g: F.when(F.array_max(g) >= CONFIRMED, gained(g, rest)))
        return let(best, lambda t: F.when(t.isNotNull(), let(at(w, t), cut)))

    return let(after, lambda rest: let(F.concat(tail, rest), lambda w: stretch(w, rest)))


def scan(docs: DataFrame, model: PipelineModel, least: float) -> DataFrame:
    """doc_id, paragraph, line, predicted, probability, likeness, family, version."""
    spark = docs.sparkSession
    by_family = [(r["family"], r["held"]) for r in known_bigrams(spark).orderBy("family").collect()]  # fixed rows
    known = sorted((t for _, own in by_family for t in own), key=len)
    terms_ = vocabulary(spark)
    names = F.array(*[F.lit(f) for f in FAMILIES[1:]])
    held = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*[F.array(*map(F.lit, t)) for t in own]).alias("held")) for f, own in by_family])

    def judged(rows: DataFrame, of: str, name: str) -> DataFrame:
        """Adds ``name``: the two most probable families of the words ``of``, null if
        any licence is less probable than ``least``."""
        scored = model.transform(rows.withColumn("terms", let(F.coalesce(of, F.array().cast("array<string>")), lambda w: terms(w, terms_))))
        scored = scored.withColumn("p", vector_to_array("probability"))
        each = F.zip_with(F.slice("p", 2, len(FAMILIES)), names, lambda p, f: F.struct(p.alias("probability"), f.alias("family")))
        best = F.slice(F.sort_array(each, asc=False), 1, 2)
        return scored.select(*rows.columns, F.when(F.col(of).isNotNull() & (1 - F.col("p")[0] > least), best).alias(name))

    def compared(rows: DataFrame, of: str, name: str) -> DataFrame:
        """``name`` becomes (predicted, probability, like, confirmed, version)."""
        alike = lambda own: F.transform(held, lambda h: F.struct(h["family"].alias("family"), contained(own, h["held"]).alias("like")))
        of_family = lambda all_, f: F.filter(all_, lambda a: a["family"] == f)[0]["like"]

        def result(all_: Column) -> Column:
            ours = F.transform(F.col(name), lambda b: F.struct(of_family(all_, b["family"]).alias("like"), b["probability"].alias("probability"), b["family"].alias("family")))
            return let(F.array_max(ours), lambda o: F.struct(
                o["family"].alias("predicted"),
                o["probability"].alias("probability"),
                o["like"].alias("like"),
                ((o["like"]["share"] >= CONFIRMED) & F.forall(all_, lambda a: (a["family"] == o["family"]) | (a["like"] < o["like"]))).alias("confirmed"),
                F.coalesce(version(F.col(of)), version(F.col("words"))).alias("version"),
            ))

        own = F.array_distinct(bigrams(F.col(of)))
        return rows.withColumn(name, F.when(F.col(name).isNotNull(), let(let(own, alike), result)))

    found = judged(read_on(docs, known), "words", "own").where("own is not null or over is not null")
    found = compared(compared(judged(found, "over", "wide"), "words", "own"), "over", "wide")
    # the more alike of what begins in the line and the line itself, as far as confirmed
    wide = F.col("wide")["confirmed"] & ~F.coalesce(F.col("own")["confirmed"] & (F.col("own")["like"] >= F.col("wide")["like"]), F.lit(False))
    found = found.withColumn("one", F.when(wide, F.col("wide")).otherwise(F.col("own"))).where("one is not null")
    family = F.when(F.col("one.confirmed"), F.col("one.predicted")).otherwise(UNKNOWN)
    return found.select("doc_id", "paragraph", "line", "one.predicted", F.round("one.probability", 4).alias("probability"), F.round("one.like.share", 4).alias("likeness"), family.alias("family"), "one.version")


@query("op3_licence_scan")
def op3_licence_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, *fit(docs))
