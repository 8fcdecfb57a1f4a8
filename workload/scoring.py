"""Model and annotator scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemark.functions.labels import decode, strip_bio
from pagemark.operators import agreement, calibration, confusion, sequences
from pagemark.operators.dedup import collapse_top_k
from pagemark.operators.labels import with_evaluation_labels
from pagemark.operators.ordering import indexed
from pagemark.operators.pages import reading_order
from pagemark.plans import workflows
from pagemark.plans.workflows import averages_by_annotator
from workload.views import ROW_ORDER, VOCAB, WORD_KEY, WORDS, best_words, r6, read, rounded, tokens, words

QUERIES, ORACLE = {}, {}
SCORES = ["precision", "recall", "f1"]
AVERAGES = ["accuracy", "micro_f1", *[f"{k}_{s}" for k in ("macro", "weighted") for s in SCORES]]


def judged(spark, sf, coordinates=False):
    df = words(spark, sf, coordinates=coordinates)
    return with_evaluation_labels(df, "annotator1", VOCAB, bio=False)


def flat_counts(spark, sf, scope=()):
    combinations = confusion.label_combinations(words(spark, sf), scope, ["annotator1_label", "pred"])
    return confusion.flat_confusion(combinations, "annotator1", VOCAB, scope)


def bio_counts(spark, sf, scope=()):
    return confusion.bio_confusion(words(spark, sf), "annotator1", VOCAB, ["page_id"], "word_no", scope)


FLAT = f"""{WORDS},
flat_rows AS (SELECT page_id, word_no, annotator1_label AS truth, flat AS pred, prob, x1, y1
              FROM word WHERE annotator1_label IS NOT NULL)"""
TAGGED = f"""{WORDS},
lab AS (SELECT page_id, word_no, tag AS pred, prob, coalesce(annotator1_label, 'O') AS l FROM word),
lagged AS (SELECT *, lag(l) OVER (PARTITION BY page_id ORDER BY word_no) AS prev FROM lab),
bio_rows AS (SELECT page_id, word_no, pred, CASE WHEN l = 'O' THEN 'O' WHEN l = prev THEN 'I-' || l
                    ELSE 'B-' || l END AS truth FROM lagged)"""


def _classes(source, scope=""):
    """CTEs `conf` and `cls`: counts per label pair and per class."""
    s = f"{scope}, " if scope else ""
    return f"""conf AS (SELECT {s}truth, pred, count(*) AS n FROM {source} GROUP BY ALL),
cls AS (SELECT {s}label, sum(tp) AS tp, sum(nt) AS nt, sum(np) AS np,
               coalesce(sum(tp) / CAST(nullif(sum(np), 0) AS DOUBLE), 0) AS p,
               coalesce(sum(tp) / CAST(nullif(sum(nt), 0) AS DOUBLE), 0) AS r,
               coalesce(2 * sum(tp) / CAST(sum(np) + sum(nt) AS DOUBLE), 0) AS f
        FROM (SELECT {s}truth AS label, CASE WHEN truth = pred THEN n ELSE 0 END AS tp, n AS nt, 0 AS np
              FROM conf UNION ALL SELECT {s}pred, 0, 0, n FROM conf) GROUP BY ALL)"""


_REPORT = """SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1,
       CAST(nt AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp, CAST(np AS BIGINT) AS n_pred FROM cls"""
_AVERAGE = """round(sum(tp) / CAST(sum(nt) AS DOUBLE), 6) AS accuracy,
       round(sum(tp) / CAST(sum(nt) AS DOUBLE), 6) AS micro_f1,
       round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1,
       round(sum(p * nt) / sum(nt), 6) AS weighted_precision,
       round(sum(r * nt) / sum(nt), 6) AS weighted_recall,
       round(sum(f * nt) / sum(nt), 6) AS weighted_f1,
       CAST(sum(tp) AS BIGINT) AS correct, CAST(sum(nt) AS BIGINT) AS total, count(*) AS classes"""


def token_accuracy(spark, sf):
    return rounded(confusion.accuracy(flat_counts(spark, sf)), "token_accuracy")


QUERIES["token_accuracy"] = token_accuracy
ORACLE["token_accuracy"] = f"""WITH {FLAT}
SELECT round(count(*) FILTER (truth = pred) / CAST(count(*) AS DOUBLE), 6) AS token_accuracy,
       count(*) AS total_tokens, count(*) FILTER (truth = pred) AS correct_predictions FROM flat_rows"""


def class_report_flat(spark, sf):
    return rounded(confusion.class_report(flat_counts(spark, sf)), *SCORES)


QUERIES["class_report_flat"] = class_report_flat
ORACLE["class_report_flat"] = f"WITH {FLAT}, {_classes('flat_rows')} {_REPORT}"


def class_report_bio(spark, sf):
    return rounded(confusion.class_report(bio_counts(spark, sf)), *SCORES)


QUERIES["class_report_bio"] = class_report_bio
ORACLE["class_report_bio"] = f"WITH {TAGGED}, {_classes('bio_rows')} {_REPORT}"


def class_report_averages(spark, sf):
    """Flat averages of every page and of all pages, from one confusion frame."""
    counts = confusion.with_overall(
        flat_counts(spark, sf, ["page_id"]), "page_id", ["truth", "pred"], ["n"]
    )
    levels = ["level", "page_id"]
    report = confusion.class_report(counts, levels)
    return rounded(confusion.report_averages(report, levels), *AVERAGES)


QUERIES["class_report_averages"] = class_report_averages
ORACLE["class_report_averages"] = f"""WITH {FLAT},
scoped AS (SELECT 'group' AS level, page_id, truth, pred FROM flat_rows
           UNION ALL SELECT 'overall', 'all', truth, pred FROM flat_rows),
{_classes('scoped', 'level, page_id')}
SELECT level, page_id, {_AVERAGE} FROM cls GROUP BY ALL"""


def token_f1(spark, sf):
    """Scores of raw predictions against the labels the documents came with."""
    counts = _label_counts(spark, sf)
    return rounded(confusion.report_averages(confusion.class_report(counts)), *AVERAGES)


def _label_counts(spark, sf, scope=()):
    combinations = confusion.label_combinations(words(spark, sf), scope, ["labels", "pred"])
    flat = strip_bio(decode("pred", VOCAB, "UNK"))
    return confusion.confusion(combinations, "labels", flat, scope, valid_only=False, weight="n")


LABELLED = f"""{WORDS},
labelled AS (SELECT page_id, labels AS truth, flat AS pred FROM word)"""
QUERIES["token_f1"] = token_f1
ORACLE["token_f1"] = f"WITH {LABELLED}, {_classes('labelled')} SELECT {_AVERAGE} FROM cls"


def confusion_matrix(spark, sf):
    return flat_counts(spark, sf)


QUERIES["confusion_matrix"] = confusion_matrix
ORACLE["confusion_matrix"] = f"""WITH {FLAT}
SELECT truth, pred, count(*) AS n FROM flat_rows GROUP BY ALL"""


def confusion_wide(spark, sf):
    return confusion.confusion_wide(flat_counts(spark, sf), ["ADDRESS", "MONEY", "O", "ORG"])


QUERIES["confusion_wide"] = confusion_wide
ORACLE["confusion_wide"] = f"""WITH {FLAT}
SELECT truth, count(*) FILTER (pred = 'ADDRESS') AS "ADDRESS", count(*) FILTER (pred = 'MONEY') AS "MONEY",
       count(*) FILTER (pred = 'O') AS "O", count(*) FILTER (pred = 'ORG') AS "ORG",
       CAST(0 AS BIGINT) AS other
FROM flat_rows GROUP BY truth"""


def confusion_wide_other(spark, sf):
    """Two classes have a column, the others share one."""
    return confusion.confusion_wide(flat_counts(spark, sf), ["ADDRESS", "O"])


QUERIES["confusion_wide_other"] = confusion_wide_other
ORACLE["confusion_wide_other"] = f"""WITH {FLAT}
SELECT truth, count(*) FILTER (pred = 'ADDRESS') AS "ADDRESS", count(*) FILTER (pred = 'O') AS "O",
       count(*) FILTER (pred NOT IN ('ADDRESS', 'O')) AS other
FROM flat_rows GROUP BY truth"""


def _pages(spark, sf):
    return confusion.page_metrics(_label_counts(spark, sf, ["page_id"]), "page_id")


_PAGES = f"""{LABELLED}, {_classes('labelled', 'page_id')},
page AS (SELECT page_id, CAST(sum(nt) AS BIGINT) AS num_tokens, sum(tp) / CAST(sum(nt) AS DOUBLE) AS accuracy,
                avg(f) AS f1_macro, CAST(sum(tp) AS BIGINT) AS correct FROM cls GROUP BY 1)"""


def page_metrics(spark, sf):
    names = tokens(spark, sf).select("page_id")
    per_page = indexed(_pages(spark, sf), "page_id", "page_index", sample_from=names)
    return rounded(per_page, "accuracy", "f1_macro")


QUERIES["page_metrics"] = page_metrics
ORACLE["page_metrics"] = f"""WITH {_PAGES}
SELECT page_id, num_tokens, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro, correct,
       row_number() OVER (ORDER BY page_id) - 1 AS page_index FROM page"""


def page_summary(spark, sf):
    return rounded(
        confusion.page_summary(_pages(spark, sf)),
        "page_accuracy_mean", "page_accuracy_std", "page_f1_mean", "page_f1_std", "avg_tokens_per_page",
    )


QUERIES["page_summary"] = page_summary
ORACLE["page_summary"] = f"""WITH {_PAGES}
SELECT round(avg(accuracy), 6) AS page_accuracy_mean, round(stddev_pop(accuracy), 6) AS page_accuracy_std,
       round(avg(f1_macro), 6) AS page_f1_mean, round(stddev_pop(f1_macro), 6) AS page_f1_std,
       count(*) FILTER (correct = num_tokens) AS pages_perfect_accuracy, count(*) AS total_pages,
       CAST(sum(num_tokens) AS BIGINT) AS total_tokens,
       round(sum(num_tokens) / CAST(count(*) AS DOUBLE), 6) AS avg_tokens_per_page
FROM page"""


def low_score_pages(spark, sf):
    return rounded(confusion.low_score_pages(_pages(spark, sf)), "accuracy", "f1_macro")


QUERIES["low_score_pages"] = low_score_pages
ORACLE["low_score_pages"] = f"""WITH {_PAGES}
SELECT page_id, num_tokens, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro, correct
FROM page WHERE accuracy < 0.5"""


def worst_classes(spark, sf):
    return rounded(confusion.worst_classes(confusion.class_report(bio_counts(spark, sf)), 3), *SCORES)


QUERIES["worst_classes"] = worst_classes
ORACLE["worst_classes"] = f"WITH {TAGGED}, {_classes('bio_rows')} {_REPORT} ORDER BY f, label LIMIT 3"


def error_patterns(spark, sf):
    return confusion.error_pairs(bio_counts(spark, sf))


QUERIES["error_patterns"] = error_patterns
ORACLE["error_patterns"] = f"""WITH {TAGGED}
SELECT truth, pred, count(*) AS n FROM bio_rows WHERE truth <> pred GROUP BY ALL
ORDER BY n DESC, truth, pred LIMIT 20"""


def confused_labels(spark, sf):
    return confusion.confused_labels(flat_counts(spark, sf))


QUERIES["confused_labels"] = confused_labels
ORACLE["confused_labels"] = f"""WITH {FLAT}
SELECT truth, count(*) AS errors FROM flat_rows WHERE truth <> pred GROUP BY ALL
ORDER BY errors DESC, truth LIMIT 10"""


def error_rate(spark, sf):
    combinations = confusion.label_combinations(words(spark, sf), columns=["annotator2_label", "pred"])
    df = with_evaluation_labels(combinations, "annotator2", VOCAB, bio=False)
    return rounded(
        confusion.error_rate(df, "ground_truth_flat", "pred_flat", weight="n"), "error_rate"
    )


QUERIES["error_rate"] = error_rate
ORACLE["error_rate"] = f"""WITH {WORDS}
SELECT count(*) FILTER (annotator2_label <> '' AND annotator2_label <> flat) AS total_errors,
       round(count(*) FILTER (annotator2_label <> '' AND annotator2_label <> flat)
             / CAST(count(*) AS DOUBLE), 6) AS error_rate FROM word"""


def _no_nan(df):
    return df.withColumn("kappa_score", r6(F.when(~F.isnan("kappa_score"), F.col("kappa_score")))).withColumn(
        "agreement_percentage", r6("agreement_percentage")
    )


def kappa(spark, sf):
    """Agreement on every page and overall; undefined kappas are shown as NULL."""
    pairs = confusion.with_overall(
        agreement.label_pairs(words(spark, sf), scope=["page_id"]),
        "page_id",
        ["label1", "label2"],
        ["n"],
    )
    return _no_nan(agreement.kappa(pairs, ["level", "page_id"]))


_KAPPA = """marg AS (SELECT level, page_id, label, sum(n1) AS n1, sum(n2) AS n2 FROM (
           SELECT level, page_id, label1 AS label, 1 AS n1, 0 AS n2 FROM rated
           UNION ALL SELECT level, page_id, label2, 0, 1 FROM rated) GROUP BY ALL),
chance AS (SELECT level, page_id, CAST(sum(n1 * n2) AS DOUBLE) AS s FROM marg GROUP BY ALL),
agree AS (SELECT level, page_id, count(*) AS n, count(*) FILTER (label1 = label2) AS a
          FROM rated GROUP BY ALL)
SELECT level, page_id,
       CASE WHEN CAST(n AS DOUBLE) * n = s THEN NULL
            ELSE round((CAST(a AS DOUBLE) * n - s) / (CAST(n AS DOUBLE) * n - s), 6) END AS kappa_score,
       round(a / CAST(n AS DOUBLE), 6) AS agreement_percentage,
       n AS total_dual_annotations, a AS agreement_count
FROM agree JOIN chance USING (level, page_id)"""
QUERIES["kappa"] = kappa
ORACLE["kappa"] = f"""WITH {WORDS},
both_ AS (SELECT page_id, annotator1_label AS label1, annotator2_label AS label2 FROM word
          WHERE annotator1_label IS NOT NULL AND annotator2_label <> ''),
rated AS (SELECT 'group' AS level, page_id, label1, label2 FROM both_
          UNION ALL SELECT 'overall', 'all', label1, label2 FROM both_),
{_KAPPA}"""


def kappa_raters(spark, sf):
    """Two ratings of the same documents."""
    pairs = agreement.label_pairs(read(spark, sf, "labels"), "quality", "toxic", include_unlabelled=True)
    return _no_nan(agreement.kappa(pairs))


QUERIES["kappa_raters"] = kappa_raters
ORACLE["kappa_raters"] = f"""WITH rated AS (
  SELECT 'all' AS level, 'all' AS page_id, CAST(quality AS VARCHAR) AS label1,
         CAST(toxic AS VARCHAR) AS label2 FROM labels),
{_KAPPA.replace('SELECT level, page_id,' + chr(10) + '       CASE', 'SELECT CASE')}"""


def disagreements(spark, sf):
    return agreement.disagreements(agreement.label_pairs(words(spark, sf)))


QUERIES["disagreements"] = disagreements
ORACLE["disagreements"] = f"""WITH {WORDS}
SELECT annotator1_label AS label1, annotator2_label AS label2, count(*) AS n FROM word
WHERE annotator2_label <> '' AND annotator1_label <> annotator2_label GROUP BY ALL"""


def _case_tokens(spark, sf):
    """Documents are cases."""
    return tokens(spark, sf, case=True).withColumn("pos", F.col("page_no") * 8 + F.col("word_no"))


def _judge_cases(rows):
    return with_evaluation_labels(
        rows, "annotator1", VOCAB, ["case_id"], "pos", bits=10, keep_block=True, prepare=best_words
    )


def _spans_sql(tag):
    return f"""SELECT case_id, typ, min(pos) AS s, max(pos) AS e, count(*) AS k FROM (
  SELECT *, sum(st) OVER (PARTITION BY case_id ORDER BY pos) AS sid FROM (
    SELECT *, CASE WHEN typ IS NOT NULL AND (left({tag}, 2) = 'B-' OR typ IS DISTINCT FROM
             lag(typ) OVER (PARTITION BY case_id ORDER BY pos)) THEN 1 ELSE 0 END AS st
    FROM (SELECT case_id, pos, {tag}, CASE WHEN {tag} = 'O' THEN NULL ELSE substr({tag}, 3) END AS typ
          FROM case_rows))) WHERE typ IS NOT NULL GROUP BY case_id, sid, typ"""


_CASE_ROWS = f"""{WORDS},
cl AS (SELECT CAST(o_custkey AS VARCHAR) AS case_id, page_no * 8 + word_no AS pos, tag AS pred,
              coalesce(annotator1_label, 'O') AS l FROM word JOIN orders ON page_no = o_orderkey),
cg AS (SELECT *, lag(l) OVER (PARTITION BY case_id ORDER BY pos) AS prev FROM cl),
case_rows AS (SELECT case_id, pos, pred, CASE WHEN l = 'O' THEN 'O' WHEN l = prev THEN 'I-' || l
                     ELSE 'B-' || l END AS truth FROM cg)"""


def entity_spans(spark, sf):
    return sequences.entity_spans(
        _case_tokens(spark, sf), ["case_id"], "pos", "pred_bio", bits=10, prepare=_judge_cases
    )


QUERIES["entity_spans"] = entity_spans
ORACLE["entity_spans"] = f"""WITH {_CASE_ROWS}, sp AS ({_spans_sql('pred')})
SELECT case_id, typ AS entity_type, s AS start, e AS "end", k AS tokens FROM sp"""


def sequence_scores(spark, sf):
    counts = sequences.span_counts(
        _case_tokens(spark, sf), ["case_id"], "pos", "ground_truth_bio", "pred_bio", bits=10,
        prepare=_judge_cases,
    )
    return rounded(sequences.span_scores(counts), *SCORES)


QUERIES["sequence_scores"] = sequence_scores
ORACLE["sequence_scores"] = f"""WITH {_CASE_ROWS},
ts AS ({_spans_sql('truth')}), ps AS ({_spans_sql('pred')}),
m AS (SELECT ts.typ, count(*) AS tp FROM ts JOIN ps ON ts.case_id = ps.case_id AND ts.typ = ps.typ
      AND ts.s = ps.s AND ts.e = ps.e GROUP BY 1),
c AS (SELECT typ, sum(tp) AS tp, sum(nt) AS nt, sum(np) AS np FROM (
        SELECT typ, tp, 0 AS nt, 0 AS np FROM m
        UNION ALL SELECT typ, 0, 1, 0 FROM ts UNION ALL SELECT typ, 0, 0, 1 FROM ps) GROUP BY 1),
d AS (SELECT typ, tp, nt, np, coalesce(tp / CAST(nullif(np, 0) AS DOUBLE), 0) AS p,
             coalesce(tp / CAST(nullif(nt, 0) AS DOUBLE), 0) AS r, 2 * tp / CAST(np + nt AS DOUBLE) AS f FROM c)
SELECT 'type' AS scope, typ AS entity_type, round(p, 6) AS precision, round(r, 6) AS recall,
       round(f, 6) AS f1, CAST(nt AS BIGINT) AS support FROM d
UNION ALL SELECT 'micro', NULL, round(sum(tp) / CAST(sum(np) AS DOUBLE), 6),
       round(sum(tp) / CAST(sum(nt) AS DOUBLE), 6),
       round(2 * sum(tp) / CAST(sum(np) + sum(nt) AS DOUBLE), 6), CAST(sum(nt) AS BIGINT) FROM d
UNION ALL SELECT 'macro', NULL, round(avg(p), 6), round(avg(r), 6), round(avg(f), 6),
       CAST(sum(nt) AS BIGINT) FROM d
UNION ALL SELECT 'weighted', NULL, round(sum(p * nt) / sum(nt), 6), round(sum(r * nt) / sum(nt), 6),
       round(sum(f * nt) / sum(nt), 6), CAST(sum(nt) AS BIGINT) FROM d"""


def sequence_accuracy(spark, sf):
    df = _judge_cases(_case_tokens(spark, sf))
    return rounded(
        sequences.sequence_accuracy(df, ["case_id"], "ground_truth_bio", "pred_bio"), "sequence_accuracy"
    )


QUERIES["sequence_accuracy"] = sequence_accuracy
ORACLE["sequence_accuracy"] = f"""WITH {_CASE_ROWS}
SELECT round(count(*) FILTER (truth = pred) / CAST(count(*) AS DOUBLE), 6) AS sequence_accuracy,
       count(DISTINCT case_id) AS total_sequences FROM case_rows"""


def role_spans(spark, sf):
    """Runs of the same role in conversations, with renumbered rows."""
    from pagemark.operators.labels import flat_to_bio

    df = read(spark, sf, "conversations").select("conv_id", "turn", "role")
    tagged = flat_to_bio(df, ["conv_id"], "turn", "role", "tag")
    return sequences.numbered_spans(tagged, ["conv_id"], "turn", "tag", bits=2)


QUERIES["role_spans"] = role_spans
ORACLE["role_spans"] = """WITH n AS (
  SELECT conv_id, role, row_number() OVER w - 1 AS i, lag(role) OVER w AS prev FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT *, sum(CASE WHEN role IS DISTINCT FROM prev THEN 1 ELSE 0 END)
             OVER (PARTITION BY conv_id ORDER BY i) AS sid FROM n)
SELECT conv_id, role AS entity_type, min(i) AS start, max(i) AS "end", count(*) AS tokens
FROM s GROUP BY conv_id, role, sid"""


def calibration_query(spark, sf):
    bins = calibration.calibration_bins(judged(spark, sf), "ground_truth_flat", "pred_flat")
    return rounded(bins, "fraction_correct", "mean_predicted")


_BINS = f"""{FLAT},
bins AS (SELECT CAST(greatest(ceil(prob * 10) - 1, 0) AS INTEGER) AS bin, count(*) AS n,
                count(*) FILTER (truth = pred) / CAST(count(*) AS DOUBLE) AS fraction_correct,
                sum(prob) / CAST(count(*) AS DOUBLE) AS mean_predicted FROM flat_rows GROUP BY 1)"""
QUERIES["calibration"] = calibration_query
ORACLE["calibration"] = f"""WITH {_BINS}
SELECT bin, n, round(fraction_correct, 6) AS fraction_correct, round(mean_predicted, 6) AS mean_predicted
FROM bins"""


def calibration_error(spark, sf):
    bins = calibration.calibration_bins(judged(spark, sf), "ground_truth_flat", "pred_flat")
    return rounded(calibration.calibration_error(bins), "ece")


QUERIES["calibration_error"] = calibration_error
ORACLE["calibration_error"] = f"""WITH {_BINS}
SELECT round(avg(abs(fraction_correct - mean_predicted)), 6) AS ece, count(*) AS bins FROM bins"""


def layout_accuracy(spark, sf):
    """The scored elements here are the labels that occur in the tables."""
    return rounded(
        confusion.layout_accuracy(flat_counts(spark, sf), ["ADDRESS", "MONEY", "TITLE"]), "token_accuracy"
    )


QUERIES["layout_accuracy"] = layout_accuracy
ORACLE["layout_accuracy"] = f"""WITH {FLAT}
SELECT truth, round(count(*) FILTER (truth = pred) / CAST(count(*) AS DOUBLE), 6) AS token_accuracy,
       count(*) AS total_tokens, count(*) FILTER (truth = pred) AS correct_predictions
FROM flat_rows WHERE truth IN ('ADDRESS', 'MONEY', 'TITLE') GROUP BY truth"""


def label_transitions(spark, sf):
    def best(rows):
        collapsed = collapse_top_k(rows, ROW_ORDER, WORD_KEY)
        return with_evaluation_labels(collapsed, "annotator1", VOCAB, bio=False)

    def ordered(rows):
        return reading_order(rows, "word_no", ["page_id"], prepare=best)

    return sequences.label_transitions(
        tokens(spark, sf, coordinates=True), ["page_id"], "reading_pos", "ground_truth_flat", "pred_flat",
        prepare=ordered,
    )


QUERIES["label_transitions"] = label_transitions
_TRANSITIONS = f"""{FLAT},
t AS (SELECT *, lag(truth) OVER w AS tb, lag(pred) OVER w AS pb FROM flat_rows
      WINDOW w AS (PARTITION BY page_id ORDER BY y1, x1, word_no)),
changes AS (
  SELECT page_id, count(*) AS transitions, count(*) FILTER (truth = pred AND tb = pb) AS equal
  FROM t WHERE tb IS NOT NULL GROUP BY 1)"""
ORACLE["label_transitions"] = f"WITH {_TRANSITIONS} SELECT * FROM changes"


def reading_order_similarity(spark, sf):
    found = sequences.reading_order_similarity(label_transitions(spark, sf), "page_id")
    return rounded(found, "similarity")


QUERIES["reading_order_similarity"] = reading_order_similarity
ORACLE["reading_order_similarity"] = f"""WITH {_TRANSITIONS},
s AS (SELECT 'group' AS level, page_id, transitions, equal FROM changes
      UNION ALL SELECT 'overall', 'all', sum(transitions), sum(equal) FROM changes)
SELECT level, page_id, CAST(transitions AS BIGINT) AS transitions, CAST(equal AS BIGINT) AS equal,
       round(equal / CAST(transitions AS DOUBLE), 6) AS similarity FROM s"""


def errors_by_band(spark, sf):
    return calibration.errors_by_band(judged(spark, sf), "ground_truth_flat", "pred_flat")


QUERIES["errors_by_band"] = errors_by_band
ORACLE["errors_by_band"] = f"""WITH {FLAT}
SELECT CASE WHEN prob > 0.8 THEN 'high' WHEN prob >= 0.5 THEN 'medium' ELSE 'low' END AS band,
       count(*) AS n, count(*) FILTER (truth <> pred) AS errors FROM flat_rows GROUP BY 1"""


def errors_by_quadrant(spark, sf):
    df = judged(spark, sf, coordinates=True)
    return calibration.errors_by_quadrant(df, "ground_truth_flat", "pred_flat")


QUERIES["errors_by_quadrant"] = errors_by_quadrant
ORACLE["errors_by_quadrant"] = f"""WITH {FLAT}
SELECT (CASE WHEN y1 <= 500 THEN 'top' ELSE 'bottom' END) || '-'
         || (CASE WHEN x1 <= 500 THEN 'left' ELSE 'right' END) AS quadrant,
       count(*) AS n, count(*) FILTER (truth <> pred) AS errors FROM flat_rows GROUP BY 1"""


def by_annotator(spark, sf):
    """Two runs, the predictions as they are and the confident ones only, for both annotators."""
    df = words(spark, sf)
    every = averages_by_annotator(df, VOCAB, run="all")
    sure = averages_by_annotator(df.filter(F.col("prob") > 0.5), VOCAB, run="confident")
    return rounded(every.unionByName(sure), *AVERAGES)


QUERIES["by_annotator"] = by_annotator
ORACLE["by_annotator"] = f"""WITH {WORDS},
side AS (SELECT 'annotator1' AS annotator, annotator1_label AS truth, flat AS pred, prob FROM word
         UNION ALL SELECT 'annotator2', annotator2_label, flat, prob FROM word),
runs AS (SELECT 'all' AS run, annotator, truth, pred FROM side WHERE truth <> ''
         UNION ALL SELECT 'confident', annotator, truth, pred FROM side WHERE truth <> '' AND prob > 0.5),
{_classes('runs', 'run, annotator')}
SELECT run, annotator, {_AVERAGE} FROM cls GROUP BY ALL"""


def by_case(spark, sf):
    """Scores per case with either annotator as the truth."""
    return rounded(averages_by_annotator(words(spark, sf, case=True), VOCAB, ["case_id"]), *AVERAGES)


QUERIES["by_case"] = by_case
ORACLE["by_case"] = f"""WITH {WORDS},
side AS (SELECT page_no, 'annotator1' AS annotator, annotator1_label AS truth, flat AS pred FROM word
         UNION ALL SELECT page_no, 'annotator2', annotator2_label, flat FROM word),
runs AS (SELECT CAST(o_custkey AS VARCHAR) AS case_id, annotator, truth, pred
         FROM side JOIN orders ON page_no = o_orderkey WHERE truth <> ''),
{_classes('runs', 'case_id, annotator')}
SELECT case_id, annotator, {_AVERAGE} FROM cls GROUP BY ALL"""


def evaluation_summary(spark, sf):
    return workflows.evaluation_summary(words(spark, sf), VOCAB, scope="page_id")


QUERIES["evaluation_summary"] = evaluation_summary
ORACLE["evaluation_summary"] = """
SELECT count(DISTINCT l_orderkey) AS total_files, 'annotator1' AS ground_truth_annotator,
       7 AS total_entity_labels FROM lineitem"""
