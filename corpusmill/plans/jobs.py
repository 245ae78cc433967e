"""End-to-end jobs: candidates, corpus, features, analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.functions import tokens as K
from corpusmill.operators import catalog as cat
from corpusmill.operators import centroid as N
from corpusmill.operators import evaluate as E
from corpusmill.operators import folds as D
from corpusmill.operators import forest as R
from corpusmill.operators import groups as G
from corpusmill.operators import models as M
from corpusmill.operators import quota as Q
from corpusmill.operators.characters import character_counts, mention_counts
from corpusmill.operators.importance import permutation_importance
from corpusmill.operators.tokens import gazetteer_mentions
from corpusmill.params import Settings, lexicon
from corpusmill.runtime import at_once, computed_once, materialise, scratch, spread
from corpusmill.sources import tables as T
from corpusmill.sources.catalog import CATALOG_COLUMNS, read_catalog, require_columns

def only_ids(texts: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """The texts with a listed id; how they meet is left to the optimiser."""
    return texts.join(ids.select(id_col), id_col, "left_semi")


def build_candidates(spark: SparkSession, catalog: str | DataFrame, out: str, settings: Settings) -> DataFrame:
    """Catalog to candidate table; the filter counts go next to it.

    The catalog is a CSV file, or a table with the columns of ``read_catalog``:
    cells with line breaks keep a CSV file from being split, so a very large
    catalog should come as a table.
    """
    catalog = read_catalog(spark, catalog) if isinstance(catalog, str) else require_columns(catalog, CATALOG_COLUMNS.values())
    table = cat.candidates(catalog, settings.selection, settings.epochs)
    T.write_table(cat.filter_funnel(catalog, settings.selection, settings.epochs), out + "_filter_counts", fmt="csv")
    T.write_table(table.orderBy("shuffle_key", "id"), out)
    return T.read_table(spark, out, T.CANDIDATE_SCHEMA)


def word_counts(texts: DataFrame, *, id_col: str = "id", raw: str = "raw") -> DataFrame:
    """``(id, n_words)`` of the cleaned texts; no text leaves its task."""
    clean = spread(texts).select(id_col, X.clean_text(X.strip_boilerplate(F.col(raw))).alias("clean"))
    return computed_once(clean.select(id_col, X.count_clean_words(F.col("clean")).alias("n_words")), "n_words")


def select_corpus(candidates: DataFrame, counts: DataFrame, selection, *, general: bool = False) -> DataFrame:
    """Candidates with a text of at least ``min_words`` words, under the quotas."""
    eligible = candidates.join(counts.where(F.col("n_words") >= selection.min_words), "id")
    rule = dict(author="author", group="epoch", order=["shuffle_key", "id"],
                per_author=selection.max_per_author, per_group=selection.max_per_epoch)
    if general:
        return Q.quota_select_general(eligible, **rule)
    return Q.quota_select(eligible, **rule)


def build_corpus(candidates: DataFrame, texts: DataFrame, out: str, settings: Settings, *,
                 general: bool = True) -> DataFrame:
    """Candidate table and landed texts to the corpus table.

    Short texts use up no quota, so the words of all candidate texts are
    counted first.
    """
    spark = candidates.sparkSession
    with scratch(spark):
        counts = word_counts(only_ids(texts, candidates))
        T.write_table(select_corpus(candidates, counts, settings.selection, general=general), out)
    return T.read_table(spark, out, T.CORPUS_SCHEMA)


def samples(texts: DataFrame, sampling, *, keep: list[str] = (), raw: str = "raw",
            short: bool = False) -> DataFrame:
    """``(id, .., sample)`` for every text long enough for a sample.

    The raw text is cut down to the passage before anything else sees it. With
    ``short`` the other texts stay, with a null sample.
    """
    clean = spread(texts).select("id", *keep, X.clean_text(X.strip_boilerplate(F.col(raw))).alias("clean"))
    cut = X.with_sample(clean, "clean", skip_fraction=sampling.skip_fraction, sample_words=sampling.sample_words)
    rows = computed_once(cut.select("id", *keep, "sample"), "sample")
    return rows if short else rows.where(F.col("sample").isNotNull())


def style_features(passages: DataFrame, style, *, mentions: DataFrame | None = None,
                   names: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """``(id, four features)`` of ``(id, lang, sample)`` rows.

    Person mentions come from a given ``mentions`` table ``(doc_id, name)``,
    from a ``names`` list, or from titles in the text. Three measures are
    narrow; only the few mentions are shuffled and joined back by id. With
    ``strict`` a passage shorter than one window is an error, not a null.
    """
    measured = (K.with_style(passages, "sample", window=style.window, lexicon=lexicon(style.pos), strict=strict)
                .drop("sample", "lang"))
    if mentions is None and names is not None:
        mentions = gazetteer_mentions(passages, names, doc_id="id", text="sample")
    if mentions is None:
        mentions = passages.select(F.col("id").alias("doc_id"),
                                   F.explode(K.cue_mentions(F.col("sample"), style.titles)).alias("name"))
    people = character_counts(mention_counts(mentions, style.titles), style.min_mentions)
    density = F.try_divide(F.coalesce("characters", F.lit(0)).cast("double"), F.col("n_words").cast("double")) * 1000
    return (measured.join(people.withColumnRenamed("doc_id", "id"), "id", "left")
            .select("id", "median_sentence_length", "sttr", "function_word_ratio",
                    density.alias("character_density")))


def new_rows(todo: DataFrame, done: DataFrame | None, id_col: str = "id") -> DataFrame:
    """Rows whose id is not in ``done``."""
    return todo if done is None else todo.join(done.select(id_col), id_col, "left_anti")


def assert_texts(corpus: DataFrame, texts: DataFrame) -> None:
    """Every text of the corpus has landed, or an error names some that have not."""
    lost = corpus.select("id").join(texts.select("id"), "id", "left_anti").limit(5).collect()
    if lost:
        raise ValueError(f"no text for the ids {[r['id'] for r in lost]}")


def build_features(corpus: DataFrame, texts: DataFrame, out: str, settings: Settings, *,
                   mentions: DataFrame | None = None, names: DataFrame | None = None,
                   strict: bool = True) -> DataFrame:
    """Append the features of texts that the table at ``out`` does not have yet.

    A text without a sample leaves no row and is tried again on the next run.
    With ``strict`` a text that has not landed, or a sample shorter than one
    window, is an error.
    The samples are written once, because the measures, the mentions and the
    check for lost texts all read them; the texts themselves are read once.
    """
    spark = corpus.sparkSession
    done = T.read_table(spark, out, T.FEATURE_SCHEMA) if T.table_exists(spark, out) else None
    todo = new_rows(corpus, done)
    with scratch(spark):
        cut = materialise(samples(only_ids(texts, todo), settings.sampling, keep=["lang"], short=True), "samples")
        if strict:
            assert_texts(todo, cut)
        passages = cut.where(F.col("sample").isNotNull())
        rows = style_features(passages, settings.style, mentions=mentions, names=names, strict=strict)
        fresh = todo.select(*T.METADATA_COLUMNS).join(rows, "id")
        T.write_table(fresh.select(*T.FEATURE_SCHEMA.fieldNames()), out, mode="append")
    return T.read_table(spark, out, T.FEATURE_SCHEMA)


def all_cross_validation(train: DataFrame, *, id_col: str, group: str, label: str, columns: list[str],
                         settings, fits: dict, marked: DataFrame | None = None) -> DataFrame:
    """Both kinds of folds for all models, as one table.

    Regressions of all folds are fitted together, and so are forests; other
    learners take a fit per fold. ``marked``, the rows with their folds, may be given.
    """
    folds, fit = dict(folds=settings.cv_folds, seed=settings.seed), dict(label=label, columns=columns)
    if marked is None:
        marked = E.with_both_folds(train, id_col=id_col, group=group, **fit, **folds)
    parts, learned = [], []
    for grouped, name in ((True, E.GROUPED), (False, E.RANDOM)):
        parts.append(E.cross_validate_folds(marked, fold=name, folds=settings.cv_folds, split=name, **fit))
        if E.LOGISTIC in fits:
            learned.append(lambda name=name: E.cv_scores(M.logistic_scores_by_fold(
                marked.withColumnRenamed(name, "fold"), {E.LOGISTIC: columns}, folds=settings.cv_folds, max_iter=settings.max_iter, **fit), name))
        others = {n: f for n, f in fits.items() if n not in (E.LOGISTIC, E.FOREST)}
        if others:
            learned.append(lambda name=name, grouped=grouped, others=others: M.cross_validate(
                train, others, id_col=id_col, group=group, label=label, split=name, grouped=grouped, **folds))
    if E.FOREST in fits:
        learned.append(lambda: M.cross_validate_forests(marked, fit_forests(marked, settings=settings, **fit), label=label))
    out = parts[0]
    for part in [*parts[1:], *(at_once(*learned) if learned else [])]:
        out = out.unionByName(part)
    return out


def fit_forests(marked: DataFrame, *, label: str, columns: list[str], settings) -> R.Forests:
    """The forest of all rows, and those of the folds of either kind."""
    return R.fit_many(marked, M.forest_specs(settings.cv_folds), label=label, columns=columns, seed=settings.seed,
                      trees=settings.trees, min_leaf=settings.min_leaf)


def test_predictions(train: DataFrame, test: DataFrame, *, label: str, columns: list[str],
                     fitted: dict) -> DataFrame:
    """The test rows with a column ``pred_<model>`` for every model."""
    out = N.predict_both(test, N.fit(train, label=label, columns=columns), columns=columns,
                         baseline=E.pred_column(E.BASELINE), nearest=E.pred_column(E.CENTROID))
    for name, model in fitted.items():
        out = M.apply_model(model, out).withColumnRenamed("pred", E.pred_column(name))
    return out


def run_experiment(features: DataFrame, settings: Settings, *, id_col: str = "id", group: str = "author",
                   label: str = "epoch", columns: list[str] = tuple(T.FEATURE_COLUMNS),
                   order: list[str] | None = None) -> dict[str, DataFrame]:
    """The whole classification experiment; every result is a DataFrame.

    The rows with their part are written once, since every step reads them.
    """
    ev, columns = settings.evaluation, list(columns)
    order = list(order or settings.epochs.order)
    marked = materialise(D.with_group_folds(features, group=group, label=label, folds=ev.test_folds, seed=ev.seed,
                                            out="__part"), "split")
    train, test = (marked.where(F.col("__part") != 0).drop("__part"),
                   marked.where(F.col("__part") == 0).drop("__part"))
    D.assert_no_leak(train, test, group=group)

    fits, fit = M.default_fits(columns, label, ev), dict(label=label, columns=columns)
    folded = E.with_both_folds(train, id_col=id_col, group=group, folds=ev.cv_folds, seed=ev.seed, **fit)
    # The forest of all training rows is grown together with those of the folds.
    forests, regression, cv, ablation = at_once(
        lambda: fit_forests(folded, settings=ev, **fit),
        lambda: fits[E.LOGISTIC](train),
        lambda: all_cross_validation(train, id_col=id_col, group=group, settings=ev, marked=folded,
                                     fits={n: f for n, f in fits.items() if n != E.FOREST}, **fit),
        lambda: M.ablation_of_folds(folded.withColumnRenamed(E.GROUPED, "fold"), folds=ev.cv_folds, max_iter=ev.max_iter, **fit))
    fitted = {E.LOGISTIC: regression, E.FOREST: forests[0]}
    cv = materialise(cv.unionByName(M.cross_validate_forests(folded, forests, label=label)), "cv")
    best = E.best_model(cv).first()["model"]

    preds = materialise(test_predictions(train, test, label=label, columns=columns, fitted=fitted), "predictions")
    names = {m: E.pred_column(m) for m in (E.BASELINE, E.CENTROID, *fitted)}
    pairs = E.pair_counts(E.by_model(preds, names), truth=label, by=["model"])
    scores = E.scores(pairs, ["model"])

    if best == E.CENTROID:
        model = N.fit(train, label=label, columns=columns)
        predict = lambda rows: N.predict(rows, model, columns=columns)
    else:
        model = fitted[best]
        predict = lambda rows: M.apply_model(model, rows)
    importance = permutation_importance(test, predict, id_col=id_col, label=label, columns=columns,
                                        repeats=ev.repeats, seed=ev.seed)
    return {
        "model": model, "best": best, "cv_results": cv, "test_results": scores, "test_predictions": preds,
        "reports": E.class_report(pairs, order, ["model"]), "confusion": E.confusion(pairs, order, ["model"]),
        "misclassified": E.misclassified(preds, truth=label, pred=names[best]),
        "coefficients": M.coefficients(fitted[E.LOGISTIC], columns, order), "importance": importance,
        "ablation": ablation,
        "summary": summary_record(features, train, test, scores, best, group=group),
    }


def summary_record(features: DataFrame, train: DataFrame, test: DataFrame, scores: DataFrame, best: str, *,
                   group: str) -> DataFrame:
    """One row with the headline numbers."""
    whole = features.agg(F.count("*").alias("n_texts"), F.count_distinct(F.col(group)).alias("n_authors"))
    sizes = train.agg(F.count("*").alias("n_train")).crossJoin(test.agg(F.count("*").alias("n_test")))
    pick = lambda name, col: F.max(F.when(F.col("model") == name, F.col(col)))
    numbers = scores.agg(F.lit(best).alias("best_model"), pick(best, "accuracy").alias("test_accuracy"),
                         pick(best, "macro_f1").alias("test_macro_f1"),
                         pick(E.BASELINE, "accuracy").alias("baseline_test_accuracy"))
    return whole.crossJoin(sizes).crossJoin(numbers)


def run_analysis(features: DataFrame, out: str, settings: Settings, **columns) -> None:
    """Group statistics and the experiment, written below ``out``."""
    order = list(columns.get("order") or settings.epochs.order)
    label, group = columns.get("label", "epoch"), columns.get("group", "author")
    measured = list(columns.get("columns", T.FEATURE_COLUMNS))
    with scratch(features.sparkSession):
        results = {
            "epoch_distribution": G.distribution(features, by=label, member=group, order=order),
            "feature_summary": G.summary(features, by=label, columns=measured, order=order),
            "kruskal_tests": G.kruskal(features, by=label, columns=measured, order=order).withColumn(
                "h", F.bround("h", 3)),
            "feature_boxes": G.box_stats(features, by=label, columns=measured),
        }
        results.update(run_experiment(features, settings, **columns))
        model, best, record = results.pop("model"), results.pop("best"), results.pop("summary")
        for name, table in results.items():
            exact = name in ("kruskal_tests", "test_predictions", "misclassified")
            T.write_table(table, f"{out}/{name}", fmt="csv", digits=None if exact else 4)
        T.write_record(record, f"{out}/metrics")
        if best == E.CENTROID:
            T.write_table(model, f"{out}/best_model")
        else:
            M.save_model(model, f"{out}/best_model")
