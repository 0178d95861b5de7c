"""Sentiment classifiers: features, training data, comparison, scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import lexicon
from shelfwise.functions import catalog, text
from shelfwise.functions.ranking import global_rank
from shelfwise.operators.evaluate import class_metrics, classification_metrics
from shelfwise.operators.folds import stratified_kfold, stratified_split
from shelfwise.operators.joins import mean_sentiment
from shelfwise.operators.phrases import PhraseSegmenter, WordTerms, mine_phrases, phrase_list
from shelfwise.operators.profile import union_all
from shelfwise.session import stage

#: Hashed columns of word terms, and of those for trees, which bin every column of every row.
TERM_COLUMNS, TREE_COLUMNS = 1 << 18, 1 << 12


# Training sentences ---------------------------------------------------------


def slots(df: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Every row once per value of a listed slot."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def negation_sentences(subjects: DataFrame, words: Sequence[str]) -> DataFrame:
    """``<subject><negator> <word><suffix>`` for every combination."""
    filled = slots(slots(slots(subjects, "negator", lexicon.NEGATORS), "word", words), "suffix", lexicon.SUFFIXES)
    return filled.select(negated(*[F.col(c) for c in ("subject", "negator", "word", "suffix")]).alias("text"))


def permuted(place: Column, bits: int, key: str) -> Column:
    """A permutation of the numbers below 4 ** ``bits``: four rounds over halves, keyed by digests."""
    left, right = F.shiftright(place, bits), place.bitwiseAND((1 << bits) - 1)
    for turn in range(4):
        digest = F.md5(F.concat(F.lit(f"{key}:{turn}:"), right.cast("string")).cast("binary"))
        mixed = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").bitwiseAND((1 << bits) - 1)
        left, right = right, left.bitwiseXOR(mixed)
    return F.shiftleft(left, bits).bitwiseOR(right)


def half_bits(size: int) -> int:
    """The smallest half for which the permutation covers ``size`` places."""
    return max(1, -(-max(size - 1, 1).bit_length() // 2))


def sample_sentences(
    subjects: DataFrame, lists: Sequence[Sequence[str]], sentence: Callable[..., Column], label: int, n: int, key: str
) -> DataFrame:
    """``n`` different sentences (all, if fewer) from the product of subjects and slots, without making it.

    Places of the product come in the order of a keyed permutation and are
    decoded in mixed radix, the subject's number foremost.  Places beyond the
    product are passed over, less than three of four; more are drawn only
    while fillings that read the same leave too few sentences.  So about four
    rows a sentence are made, however many subjects there are.  ``subjects``
    has one column, without nulls.
    """
    spark, name = subjects.sparkSession, subjects.columns[0]
    listed = stage(global_rank(subjects.where(F.col(name).isNotNull()).distinct(), F.col(name), name="number"), "subjects")
    size = listed.count()
    for values in lists:
        size *= len(values)
    bits, drawn = half_bits(size), 4 * n
    while True:
        places = spark.range(min(drawn, 4**bits)).select("id", permuted(F.col("id"), bits, key).alias("place"))
        rest, filled = F.col("place"), []
        for values in reversed(lists):
            digit = F.pmod(rest, F.lit(len(values)))
            filled.insert(0, F.array(*[F.lit(v) for v in values])[digit.cast("int")])
            rest = ((rest - digit) / len(values)).cast("long")
        slots_of = places.where(F.col("place") < size).select(
            "id", (rest + 1).alias("number"), *[c.alias(f"slot{k}") for k, c in enumerate(filled)]
        )
        made = listed.join(F.broadcast(slots_of), "number")
        texts = made.select("id", text.strip(sentence(F.col(name), *[F.col(f"slot{k}") for k in range(len(lists))])).alias("text"))
        found = stage(texts.groupBy("text").agg(F.min("id").alias("id")), "sentences")
        if drawn >= 4**bits or found.count() >= n:
            return found.orderBy("id").limit(n).select("text", F.lit(label).alias("label"))
        drawn *= 2


def negated(subject: Column, negator: Column, word: Column, suffix: Column) -> Column:
    return F.concat(subject, negator, F.lit(" "), word, suffix)


def mixed(praise: Column, contrast: Column, complaint: Column) -> Column:
    return F.concat_ws(" ", praise, F.nullif(contrast, F.lit("")), complaint)


def augmentation(
    subjects: DataFrame,
    neutral_subjects: DataFrame,
    praise: DataFrame,
    sizes: tuple[int, int, int, int] = (300, 100, 250, 150),
) -> DataFrame:
    """Negated, mixed and neutral sentences with their labels, sampled from all combinations."""
    good = [lexicon.NEGATORS, lexicon.POSITIVE_WORDS, lexicon.SUFFIXES]
    bad = [lexicon.NEGATORS, lexicon.NEGATIVE_WORDS, lexicon.SUFFIXES]
    contrasts = [[*lexicon.CONTRASTS, ""], lexicon.NEGATIVE_CLAUSES]
    return union_all(
        [
            sample_sentences(subjects, good, negated, 0, sizes[0], "not good"),
            sample_sentences(subjects, bad, negated, 2, sizes[1], "not bad"),
            sample_sentences(praise, contrasts, mixed, 1, sizes[2], "mixed"),
            sample_sentences(neutral_subjects, [lexicon.NEUTRAL_PHRASES], F.concat, 1, sizes[3], "neutral"),
        ]
    )


def default_augmentation(spark) -> DataFrame:
    def column(name: str, values: Sequence[str]) -> DataFrame:
        return spark.createDataFrame([(v,) for v in values], f"{name} string")

    return augmentation(
        column("subject", lexicon.SUBJECTS),
        column("subject", lexicon.NEUTRAL_SUBJECTS),
        column("praise", lexicon.POSITIVE_CLAUSES),
    )


def with_synthetic(train: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Real and synthetic training rows; blank sentences leave with their label."""
    kept = synthetic.where(~text.is_blank(F.col("text")))
    return train.select("text", "label", F.lit(False).alias("is_synthetic")).unionByName(
        kept.select("text", "label", F.lit(True).alias("is_synthetic"))
    )


# Features -------------------------------------------------------------------


def model_text(col: Column, dictionary: Mapping[str, str] = lexicon.SHORTHAND) -> Column:
    """What a model reads: no support note, cleaned words."""
    return text.clean_text(text.strip_support_note(col), dictionary)


def with_terms(docs: DataFrame, column: str = "clean", chars: bool = False) -> DataFrame:
    """Word 1-2-grams and, if asked, in-word character 3-5-grams."""
    docs = docs.withColumn("terms", text.word_ngrams(F.col(column)))
    return docs.withColumn("chars", text.char_ngrams(F.col(column))) if chars else docs


def document_frequency(docs: DataFrame, terms: Column, least: int) -> DataFrame:
    """Number of texts each term occurs in, if at least ``least``."""
    return (
        docs.select(F.explode(F.array_distinct(terms)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= least)
    )


def smooth_idf(docs: DataFrame, terms: Column, least: int) -> DataFrame:
    """``ln((1 + n) / (1 + df)) + 1`` per term."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    return document_frequency(docs, terms, least).withColumn(
        "idf", F.log((n + 1) / (F.col("df") + 1)) + 1
    )


def fit_tfidf(
    docs: DataFrame, column: str = "terms", output: str = "tfidf", least: int = 2, size: int = TERM_COLUMNS,
) -> PipelineModel:
    """Counts, smoothed inverse frequencies plus one, unit length.

    Terms share ``size`` columns by hash, so none is left out whatever the
    number of terms, and no vocabulary is gathered.  Columns that fewer than
    ``least`` texts have count nothing.
    """
    counter = term_counter(column, f"{output}_tf", size)
    return PipelineModel(stages=[counter, *fit_weights(counter.transform(docs), output, least)])


def term_counter(column: str = "terms", output: str = "tfidf_tf", size: int = TERM_COLUMNS) -> HashingTF:
    return HashingTF(inputCol=column, outputCol=output, numFeatures=size)


def fit_weights(counted: DataFrame, output: str = "tfidf", least: int = 2, used: Sequence[bool] | None = None) -> list[Transformer]:
    """The stages of ``fit_tfidf`` behind the counts ``<output>_tf``; with ``used``, columns that it denies count nothing."""
    found = IDF(inputCol=f"{output}_tf", outputCol="_", minDocFreq=least).fit(counted)
    scales = [w + 1.0 if n >= least else 0.0 for w, n in zip(found.idf.toArray().tolist(), found.docFreq)]
    if used is not None:
        scales = [w if u else 0.0 for w, u in zip(scales, used)]
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense(scales), inputCol=f"{output}_tf", outputCol=f"{output}_raw"
    )
    return [scale, Normalizer(p=2.0, inputCol=f"{output}_raw", outputCol=output)]


def term_totals(docs: DataFrame, terms: Column, group: str) -> DataFrame:
    """Per ``group`` and term how often it occurs, and in how many texts."""
    ordered = docs.select(group, F.sort_array(terms).alias("terms"))
    before = F.concat(F.array(F.lit(None).cast("string")), "terms")
    each = F.zip_with("terms", F.slice(before, 1, F.size("terms")), lambda t, b: F.struct(t.alias("term"), F.when(t.eqNullSafe(b), 0).otherwise(1).alias("first")))
    listed = ordered.select(group, F.inline(each))
    return listed.groupBy(group, "term").agg(F.count(F.lit(1)).alias("n"), F.sum("first").alias("df"))


def frequent_terms(totals: DataFrame, least: int, most: int) -> list[str]:
    """The ``most`` most frequent terms of those in at least ``least`` texts; equal ones in order."""
    summed = totals.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).where(F.col("df") >= least)
    return [r.term for r in summed.orderBy(F.desc("n"), "term").limit(most).select("term").collect()]


def class_weights(docs: DataFrame, label: str = "label") -> DataFrame:
    """``n / (classes * n_class)`` per class."""
    counts = stage(docs.groupBy(label).agg(F.count(F.lit(1)).alias("n")), "classes")
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("class_weight", total / (classes * F.col("n")))


def with_weights(docs: DataFrame, label: str = "label") -> DataFrame:
    """Balanced class weight times review weight; one row per class joins."""
    weights = class_weights(docs, label).select(label, "class_weight")
    return docs.join(F.broadcast(weights), label).withColumn(
        "weight", F.col("class_weight") * F.col("review_weight")
    )


# Comparison -----------------------------------------------------------------

#: Rows of a task of an iterative fit, at least; the sums it sends are as wide as all columns.
FIT_ROWS = 4096


def _logit(max_iter: int, features: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, weightCol="weight", maxIter=max_iter, probabilityCol="p_lr", rawPredictionCol="raw_lr", predictionCol="pred_lr",
    )


def _svm(max_iter: int, features: str) -> LinearSVC:
    return LinearSVC(featuresCol=features, weightCol="weight", maxIter=max_iter, rawPredictionCol="raw_svm", predictionCol="pred_svm")


def part_margins(train: DataFrame, features: str, max_iter: int, part: int, svm: Callable = _svm) -> DataFrame:
    """``label, weight, margin`` of the rows of a ``part`` by an SVM that was fitted on the others."""
    margin = VectorAssembler(inputCols=["raw_svm"], outputCol="margin")
    fitted = svm(max_iter, features).fit(train.where(F.col("part") != part))
    return margin.transform(fitted.transform(train.where(F.col("part") == part))).select("label", "weight", "margin")


def out_of_fold_margins(train: DataFrame, features: str, max_iter: int, parts: int = 3, svm: Callable = _svm) -> DataFrame:
    """``label, weight, margin``: the margin of every row by an SVM that was fitted on the other ``parts``."""
    return union_all([part_margins(train, features, max_iter, p, svm) for p in range(parts)])


def _calibrate(margins: DataFrame, max_iter: int) -> LogisticRegressionModel:
    """Fitted once, on the margins of all rows out of their ``part``, so no row calibrates a model that has seen it."""
    return LogisticRegression(
        featuresCol="margin", weightCol="weight", maxIter=max_iter, probabilityCol="p_svm", rawPredictionCol="raw_cal", predictionCol="pred_cal",
    ).fit(stage(margins, "margins"))


def ensemble(logistic: Transformer, svm: Transformer, calibrated: Transformer, rows: DataFrame) -> DataFrame:
    """Mean of the logistic probability and the calibrated margin of an SVM; both are fitted on all training rows."""
    margin = VectorAssembler(inputCols=["raw_svm"], outputCol="margin")
    both = calibrated.transform(margin.transform(svm.transform(logistic.transform(rows))))
    positive = (vector_to_array("p_lr")[1] + vector_to_array("p_svm")[1]) / 2
    return both.withColumn("prediction", (positive > 0.5).cast("double"))


def fold_predictions(seen: DataFrame, asked: DataFrame, max_iter: int, trees: int, parallelism: int, parts: int = 3) -> list[DataFrame]:
    """``method, label, prediction`` of ``asked`` by the seven classifiers fitted on ``seen``.

    Every fit is a task of its own for ``parallelism`` threads, the longest first, as its jobs are short.  The logistic
    model and the SVM of the words are fitted once, for themselves and for their ensemble.
    """
    sides = ["word_char", "word_polarity", "word"]
    with ThreadPoolExecutor(parallelism) as pool:
        margins = {f: [pool.submit(part_margins, seen, f, max_iter, p) for p in range(parts)] for f in sides}
        svms = {f: pool.submit(_svm(max_iter, f).fit, seen) for f in sides}
        forest = pool.submit(RandomForestClassifier(numTrees=trees, seed=42, featuresCol="word_few", weightCol="weight").fit, seen)
        logits = {f: pool.submit(_logit(max_iter, f).fit, seen) for f in sides}
        bayes = pool.submit(NaiveBayes(featuresCol="word", weightCol="review_weight").fit, seen)
        calibrated = {f: pool.submit(_calibrate, union_all([m.result() for m in margins[f]]), max_iter) for f in sides}
        mixed = {f: ensemble(logits[f].result(), svms[f].result(), calibrated[f].result(), asked) for f in sides}
    scored = {
        "naive_bayes": bayes.result().transform(asked),
        "random_forest": forest.result().transform(asked),
        "logistic": logits["word"].result().transform(asked).withColumnRenamed("pred_lr", "prediction"),
        "linear_svm": svms["word"].result().transform(asked).withColumnRenamed("pred_svm", "prediction"),
        "ensemble": mixed["word"],
        "ensemble_chars": mixed["word_char"],
        "ensemble_polarity": mixed["word_polarity"],
    }
    return [rows.select(F.lit(name).alias("method"), "label", "prediction") for name, rows in scored.items()]


METHODS = ["majority", "naive_bayes", "random_forest", "logistic", "linear_svm", "ensemble", "ensemble_chars", "ensemble_polarity"]


def majority(train: DataFrame, rows: DataFrame) -> DataFrame:
    """The most common label of the training rows for every row."""
    common = train.groupBy("label").count().agg(F.max(F.struct("count", (-F.col("label")).alias("l"))).alias("m"))
    return rows.withColumn("prediction", common.select(-F.col("m.l")).scalar().cast("double"))


def compare_classifiers(
    docs: DataFrame, folds: int = 5, max_iter: int = 1000, trees: int = 200, parallelism: int = 8
) -> DataFrame:
    """Out-of-fold metrics of eight classifiers on the same folds.

    ``docs``: ``key, clean, label (0/1), review_weight``.  The classifiers of
    a fold are fitted side by side, as their jobs are short.
    """
    polarity = text.cue_polarity(F.col("clean"), lexicon.POSITIVE_CUES, lexicon.NEGATIVE_CUES)
    dealt = stratified_kfold(stage(docs, "texts"), "key", k=folds)
    inner = F.pmod(F.crc32(F.concat(F.lit("part "), F.col("key").cast("string")).cast("binary")), F.lit(3)).cast("int")
    rows = stage(dealt.withColumns({"polarity": polarity, "part": inner}), "folds", even=True)
    # Texts are taken apart twice, for the terms of all folds and for the counts that all folds weigh anew.
    totals = stage(term_totals(rows, text.char_ngrams(F.col("clean")), "fold"), "totals")
    listed = [frequent_terms(totals.where(F.col("fold") != fold), 3, 20_000) for fold in range(folds)]
    every = sorted(set().union(*listed))
    counters = [
        term_counter("terms", "word_tf"),
        term_counter("terms", "word_few_tf", TREE_COLUMNS),
        CountVectorizerModel.from_vocabulary(every, inputCol="chars", outputCol="char_tf"),
    ]
    counted = PipelineModel(stages=counters).transform(with_terms(rows, chars=True))
    kept = ["label", "review_weight", "polarity", "fold", "part", *map(unnamed, ["word_tf", "word_few_tf", "char_tf"])]
    counted = stage(counted.select(*kept), "counted", even=True)
    predicted = []
    for fold in range(folds):
        train, held = counted.where(F.col("fold") != fold), counted.where(F.col("fold") == fold)
        known = set(listed[fold])
        joined = PipelineModel(
            stages=[
                *fit_weights(train, "word"),
                *fit_weights(train, "word_few"),
                *fit_weights(train, "char", 3, [t in known for t in every]),
                VectorAssembler(inputCols=["word", "char"], outputCol="word_char"),
                VectorAssembler(inputCols=["word", "polarity"], outputCol="word_polarity"),
            ]
        )
        used = ["label", *map(unnamed, ["word", "word_few", "word_char", "word_polarity"])]
        seen = stage(joined.transform(with_weights(train)).select(*used, "weight", "review_weight", "part"), "seen", even=True)
        seen = seen.coalesce(max(1, seen.count() // FIT_ROWS)).persist()
        asked = stage(joined.transform(held).select(*used), "asked", even=True)
        scored = fold_predictions(seen, asked, max_iter, trees, parallelism)
        predicted.append(stage(union_all([majority(train, held).select(F.lit("majority").alias("method"), "label", "prediction"), *scored]), f"predicted_{fold}"))
        seen.unpersist()
    found = union_all(predicted)
    return union_all([method_metrics(found, name) for name in METHODS])


def unnamed(vector: str) -> Column:
    """The vector without a name per feature, which would burden every plan."""
    return F.col(vector).alias(vector, metadata={})


def method_metrics(scored: DataFrame, method: str) -> DataFrame:
    per_class = class_metrics(scored.where(F.col("method") == method))

    def of(metric: str, value: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("class") == value, F.col(metric))), F.lit(0.0))

    return per_class.agg(
        F.lit(method).alias("method"),
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        of("f1", 1).alias("f1_pos"),
        of("recall", 1).alias("recall_pos"),
        of("recall", 0).alias("recall_neg"),
    )


# Training and scoring -------------------------------------------------------


def fit_sentiment(
    train: DataFrame, max_iter: int = 100, penalty: float = 0.01, phrases: Sequence[str] | None = None,
) -> PipelineModel:
    """Three classes from the segmented words of cleaned texts (``clean, label``).

    The model reads ``clean``: it joins phrases, those mined from the training texts or ``phrases``, takes terms,
    weighs and classifies them.  All of it is saved with the model and works row by row, on streams too.
    """
    prepared, model = _prepared(train, phrases)
    return PipelineModel(stages=[*model.stages, _logistic(max_iter, penalty).fit(prepared)])


def _logistic(max_iter: int, penalty: float) -> LogisticRegression:
    return LogisticRegression(featuresCol="tfidf", family="multinomial", maxIter=max_iter, regParam=penalty)


def _prepared(train: DataFrame, phrases: Sequence[str] | None = None) -> tuple[DataFrame, PipelineModel]:
    """``label, tfidf`` of the training texts, stored, and the stages that made them."""
    texts = stage(train.select("clean", "label"), "clean", even=True)
    if phrases is None:
        numbered = texts.withColumn("_row", F.monotonically_increasing_id())
        phrases = phrase_list(mine_phrases(numbered, "_row", "clean"))
    words = [PhraseSegmenter(phrases), WordTerms(), term_counter()]
    # Counts are stored, not terms, which are several times longer than their texts.
    counted = stage(PipelineModel(stages=words).transform(texts).select(unnamed("tfidf_tf"), "label"), "counted", even=True)
    weights = fit_weights(counted)
    rows = stage(PipelineModel(stages=weights).transform(counted).select("label", "tfidf"), "tfidf")
    return rows, PipelineModel(stages=[*words, *weights])


def macro_f1(scored: DataFrame) -> float:
    return class_metrics(scored).agg(F.coalesce(F.avg("f1"), F.lit(0.0))).first()[0]


#: Penalties that a training run compares, strongest first.
PENALTIES = (0.1, 0.03, 0.01, 0.003, 0.001)


def select_penalty(
    train: DataFrame, held: DataFrame, max_iter: int = 100, penalties: Sequence[float] = PENALTIES, parallelism: int = 4,
) -> list[tuple[float, float]]:
    """Each penalty with the macro-F1 over ``held`` of the model that it gives on ``train``; the texts are prepared once."""
    rows, stages = _prepared(train)
    asked = stage(stages.transform(held.select("clean", "label")).select("label", "tfidf"), "asked")

    def scored(penalty: float) -> tuple[float, float]:
        return penalty, macro_f1(_logistic(max_iter, penalty).fit(rows).transform(asked).select("label", "prediction"))

    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(scored, penalties))


def train_sentiment(
    labeled: DataFrame, synthetic: DataFrame, key: str = "key", max_iter: int = 100, penalties: Sequence[float] = PENALTIES,
) -> tuple[PipelineModel, DataFrame]:
    """The model, and its metrics on held-out real rows only.

    ``labeled``: ``key, clean, label``; ``synthetic``: ``text, label``.  The penalty is the one with the best macro-F1 over
    a part held out of the training rows (of equals the strongest); then all training rows fit the model.  Metrics
    also tell the ``penalty`` (key ``chosen``) and the ``selection_f1`` of each one compared.
    """
    parts = stage(stratified_split(stage(labeled, "labeled"), key), "split")
    extra = synthetic.select(text.clean_text(F.col("text"), lexicon.SHORTHAND).alias("text"), "label")
    real = parts.where(~F.col("is_test")).drop("is_test").withColumn("_key", F.concat(F.lit("inner "), F.col(key).cast("string")))
    inner = stage(stratified_split(real, "_key").select(F.col("clean").alias("text"), "label", "is_test"), "inner")

    def fitted_on(rows: DataFrame) -> DataFrame:
        return with_synthetic(rows.select("text", "label"), extra).withColumnRenamed("text", "clean")

    tried = select_penalty(
        fitted_on(inner.where(~F.col("is_test"))), inner.where(F.col("is_test")).withColumnRenamed("text", "clean"), max_iter, penalties,
    )
    chosen = max(tried, key=lambda t: (t[1], t[0]))[0]
    model = fit_sentiment(fitted_on(inner), max_iter, chosen)
    held = model.transform(parts.where(F.col("is_test")))
    selection = [("penalty", "chosen", chosen)] + [("selection_f1", f"{p:g}", score) for p, score in tried]
    about = labeled.sparkSession.createDataFrame(selection, "metric string, key string, value double")
    return model, classification_metrics(held.select("label", "prediction")).unionByName(about)


def score_sentiment(
    reviews: DataFrame, model: PipelineModel, column: str = "Review_Text", names: Mapping[int, str] = lexicon.LABEL_NAMES
) -> DataFrame:
    """Label, name, confidence, probabilities and cleaned text; blank texts leave."""
    asked = reviews.where(~text.is_blank(F.col(column))).withColumn("clean", model_text(F.col(column)))
    scored = model.transform(asked)
    chances = vector_to_array("probability")
    label = F.col("prediction").cast("int")
    by_name = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names.values()]), F.slice(chances, 1, len(names))
    )
    return scored.select(
        *reviews.columns,
        label.alias("label"),
        catalog.label_name(label, names).alias("label_name"),
        F.array_max(chances).alias("confidence"),
        by_name.alias("probabilities"),
        F.col("clean").alias("cleaned_text"),
    )


def sentiment_by_product(scored: DataFrame, positive: str = "positive") -> DataFrame:
    """Mean positive probability per product."""
    chance = F.try_element_at("probabilities", F.lit(positive))
    return mean_sentiment(scored.withColumn("Sentiment_Score", chance))
